"""Fuzzy line deduplication by MinHash.

Everything here is DataFrame and SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.multiply import maybe_wanted
from .common import materialize
from .components import components

#: Characters of a shingle (a shorter line is one shingle); one starts at each character.
SHINGLE = 12

#: Bins of the signature and how many of them make a band. At similarity 0.8 two lines share
#: a bin with probability 0.8 and one of nine bands in all but 0.488 ** 9 = 0.16 % of cases.
BINS, ROWS = 27, 3

#: Words of 64 bits in a line's sketch.
WORDS = 2 * BINS

#: Lines that one part of a band has at most on average; larger bands are compared in pairs of parts.
PART = 256

#: Mixed bands of more lines are thinned out before all their pairs are compared: each line meets
#: so many others that the first step has not connected it with.
LARGE, MET = 32, 4

#: Least Jaccard similarity of the sets of shingles.
SIMILARITY = 0.8

#: The JVM never compiles methods of more than 8,000 bytes. Rows of one or two sketches make such, unless Spark holds its code to that.
_METHODS = {"spark.sql.codegen.hugeMethodLimit": "8000"}

_BANDS = BINS // ROWS
_WIDTH = -(-(1 << 31) // BINS)
_WORD = -(-(1 << 31) // WORDS)


def _places(code: Column) -> Column:
    """Where shingles start in a line of UTF-32."""
    return F.sequence(F.lit(0), F.greatest((F.length(code) / 4).cast("int") - SHINGLE, F.lit(0)))


def _hash(code: Column, place: Column) -> Column:
    """31-bit hash of the shingle that starts at a character of a line of UTF-32."""
    return F.shiftrightunsigned(F.xxhash64(F.substring(code, place * 4 + 1, F.lit(4 * SHINGLE))), 33).cast("int")


def shingles(line: Column) -> Column:
    """Sorted distinct 31-bit hashes of a line's character shingles.

    A shingle is ``SHINGLE`` consecutive characters, white space included; one starts at each
    character that has so many from it on. A shorter line is one shingle.
    """
    found = F.transform(F.array(F.encode(line, "UTF-32")), lambda c: F.transform(_places(c), lambda i: _hash(c, i)))[0]
    return F.sort_array(F.array_distinct(found))


def _windows(line: Column) -> Column:
    """The distinct shingles of a line themselves: what ``shingles`` hashes, without a function per shingle."""
    found = F.regexp_extract_all(line, F.lit(f"(?s)(?=(.{{{SHINGLE}}}))."), F.lit(1))
    return F.when(F.char_length(line) > SHINGLE, F.array_distinct(found)).otherwise(F.array(line))


def banded(rows: DataFrame) -> DataFrame:
    """``(a, b, place, band)`` for each distinct ``(a, b)`` of ``rows`` (``a, b, line``) and each of its band keys.

    One permutation, cut into ``BINS`` equal ranges: a signature holds the least hash of
    each, -1 for an empty one; ``ROWS`` neighbouring bins make a band. A band of empty bins
    has no key. Equal lines meet first, once within their task and once by ``(a, b)``; there
    the shingles are rows that meet in one minimum per bin of a band, in place.
    """
    once = rows.groupBy("a", "b").agg(F.min("line").alias("line"))
    hashed = _hashed(once).select("a", "b", "h", F.expr(f"h div {_WIDTH}").alias("bin"))
    placed = hashed.select("a", "b", "h", F.expr(f"cast(bin div {ROWS} as int)").alias("place"), F.expr(f"cast(bin % {ROWS} as int)").alias("row"))
    least = placed.groupBy("a", "b", "place").agg(*(F.min(F.when(F.col("row") == r, F.col("h"))).alias(f"m{r}") for r in range(ROWS)))
    return least.select("a", "b", F.col("place").cast("byte").alias("place"), F.xxhash64("place", *(F.coalesce(f"m{r}", F.lit(-1)) for r in range(ROWS))).alias("band"))


def _hashed(rows: DataFrame) -> DataFrame:
    """``(a, b, h)``: each shingle of each line as a row."""
    coded = rows.select("a", "b", F.encode("line", "UTF-32").alias("code"))
    places = coded.select("a", "b", "code", F.explode_outer(_places(F.col("code"))).alias("place"))
    return places.select("a", "b", _hash(F.col("code"), F.col("place")).alias("h"))


def sketched(rows: DataFrame) -> DataFrame:
    """``(a, b, n, low, s0, s1, ..)`` of lines ``(a, b, line)``: number of shingles, least hash, and a bitmap in ``WORDS`` words.

    A shingle sets one of a word's 64 bits, so two lines differ in at most as many bits as
    there are shingles that one of them lacks. ``n`` counts repeated shingles, too.
    """
    hashed = _hashed(rows.repartition("a", "b"))
    bins = hashed.select("a", "b", "h", F.expr(f"cast(h div {_WORD} as int)").alias("bin"), F.expr("shiftleft(1L, h & 63)").alias("bit"))
    bins = bins.groupBy("a", "b", "bin").agg(F.min("h").alias("h"), F.count("*").alias("n"), F.bit_or("bit").alias("bits"))
    words = (F.coalesce(F.max(F.when(F.col("bin") == k, F.col("bits"))), F.lit(0).cast("long")).alias(f"s{k}") for k in range(WORDS))
    return bins.groupBy("a", "b").agg(F.sum("n").alias("n"), F.min("h").alias("low"), *words)


_SKETCH = ["n", *(f"s{k}" for k in range(WORDS))]
_KEYS = [f"k{p}" for p in range(_BANDS)]


def _likely(one: str, two: str) -> Column:
    """False only if sketches, columns with these endings, show that two lines are not alike."""
    differ = sum((F.bit_count(F.col(f"s{k}{one}").bitwiseXOR(F.col(f"s{k}{two}"))) for k in range(WORDS)), F.lit(0))
    # sets of similarity S differ in at most (1 - S) / (1 + S) of the sum of their sizes
    return (1 + SIMILARITY) * differ <= (1 - SIMILARITY) * (F.col(f"n{one}") + F.col(f"n{two}")) + 1e-6


def _ended(rows: DataFrame, end: str, *columns: str) -> DataFrame:
    return rows.select(*(F.col(c).alias(f"{c}{end}") for c in columns))


def lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(node, line)``: the \\n-separated lines that have a word, ``node`` being document and place (from 0)."""
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.posexplode(F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "\n")).alias("at", "line"))
    return rows.filter(F.col("line").rlike(r"[^\x20\x09-\x0D]")).select(F.struct("doc", "at").alias("node"), "line")


def _named(rows: DataFrame) -> DataFrame:
    """Equal lines have equal ``a`` and ``b``: 128 bits of hash stand for the text."""
    return rows.withColumns({"a": F.xxhash64("line"), "b": F.xxhash64("line", F.lit(1))})


def _alike(one: str, two: str) -> Column:
    """Whether two sets reach ``SIMILARITY``; sizes decide before the sets are compared."""
    a, b = F.size(one), F.size(two)
    common = F.size(F.array_intersect(one, two))
    # common >= SIMILARITY * (a + b - common), with one evaluation of common
    return (a >= SIMILARITY * b) & (b >= SIMILARITY * a) & ((1 + SIMILARITY) * common >= SIMILARITY * (a + b) - 1e-6)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Rows of ``pairs`` (``a1, b1, a2, b2``) whose lines are alike. Texts travel, the sets are made where they meet."""
    both = pairs.join(_ended(texts, "1", "a", "b", "line"), ["a1", "b1"]).join(_ended(texts, "2", "a", "b", "line"), ["a2", "b2"])
    sets = F.array(F.struct(_windows(F.col("line1")).alias("one"), _windows(F.col("line2")).alias("two")))
    both = both.select(*pairs.columns, F.explode(sets).alias("sets"))  # each set is made once, in compiled code
    return both.filter(_alike("sets.one", "sets.two")).select(*pairs.columns)


def _keep(df: DataFrame, name: str) -> DataFrame:
    """``df`` kept; large methods of the code that makes it are cut into ones that the JVM compiles."""
    return materialize(df, name, shuffles=False, conf=_METHODS)


def _under(rows: DataFrame, tops: DataFrame) -> DataFrame:
    """``rows`` with each ``root`` that ``tops`` (``node, root``) puts under another replaced by that."""
    tops = tops.select(F.col("node").alias("root"), F.col("root").alias("_top"))
    return rows.join(tops, "root", "left").withColumn("root", F.coalesce("_top", "root")).select(*rows.columns)


def _mixed(placed: DataFrame) -> DataFrame:
    """``(band)`` of lines that are not all connected yet."""
    ends = [f(f"root.{c}").alias(f"{n}{c}") for c in "ab" for n, f in (("min", F.min), ("max", F.max))]
    return placed.groupBy("band").agg(*ends).filter("mina != maxa OR minb != maxb").select("band")


def _links(bands: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(a, b, root)`` of lines, and ``(node, root)`` of these roots in a last step.

    The first step compares each line of a band with the one whose bands are largest (of
    near copies of one line that is the line itself) and with the one before it, in the order
    of their least hashes. What it connects isn't compared again: the second step compares
    all other pairs of each band, each pair in the first band that it shares, so that no pair
    is left out, and a cluster of lines that are alike doesn't give the square of its size.
    Between the two, each line of a large band with several roots meets ``MET`` lines of others:
    clusters that are alike become one there, and leave no product of their sizes to the second step.

    Band keys alone are counted first. Bitmaps of 8 MiB, whatever the number of lines, keep
    rows of lone bands and texts of lone lines from travelling; what is left over is told
    apart exactly. Sketches tell most pairs that are not alike apart; sets are made only for
    pairs that they leave, and neither kept nor shuffled.
    """
    shared = bands.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1").select("band")
    near = maybe_wanted(bands, shared, ["band"])
    near = near.select("place", "band", "a", "b", F.count("*").over(W.partitionBy("band")).alias("n")).filter("n > 1")
    near = _keep(near, "bands")
    # the texts of lines that share a band only: these are looked up in the documents again
    held = (F.max(F.when(F.col("place") == p, F.col("band"))).alias(k) for p, k in enumerate(_KEYS))
    keys = near.groupBy("a", "b").agg(F.sum("n").alias("met"), *held)
    wanted = keys.select("a", "b")
    texts = maybe_wanted(rows, wanted, ["a", "b"]).groupBy("a", "b").agg(F.min("line").alias("line"))
    texts = _keep(texts.join(wanted, ["a", "b"], "left_semi"), "texts")
    sketches = _keep(sketched(texts).join(keys, ["a", "b"]), "sketches")
    band = W.partitionBy("band")
    node = F.struct("a", "b")
    pairs = near.join(sketches.select("a", "b", "low", "met"), ["a", "b"])
    pairs = pairs.select("a", "b", F.max(F.struct("met", "a", "b")).over(band).alias("top"), F.lag(node).over(band.orderBy("low", "a", "b")).alias("last"))
    pairs = pairs.select("a", "b", F.explode(F.array(F.struct("top.a", "top.b"), "last")).alias("x"))
    pairs = pairs.select(F.col("a").alias("a1"), F.col("b").alias("b1"), F.col("x.a").alias("a2"), F.col("x.b").alias("b2"))
    pairs = pairs.filter("a1 != a2 OR b1 != b2").distinct()
    for end in "12":
        pairs = pairs.join(_ended(sketches, end, "a", "b", *_SKETCH), [f"a{end}", f"b{end}"])
    pairs = _keep(pairs.filter(_likely("1", "2")).select("a1", "b1", "a2", "b2"), "candidates")
    alike = _verified(pairs, texts)
    roots = components(alike.select(F.struct(F.col("a1").alias("a"), F.col("b1").alias("b")).alias("x"), F.struct(F.col("a2").alias("a"), F.col("b2").alias("b")).alias("y")), "x", "y")
    roots = _keep(roots.select("node.a", "node.b", "root"), "roots")
    own = F.coalesce("root", node)
    placed = near.join(roots, ["a", "b"], "left").select("band", "a", "b", "n", own.alias("root"))
    placed = _keep(placed, "placed")
    # large bands: each line and some of other roots, in an order of its own for each band
    some = placed.filter(F.col("n") > LARGE)
    some = some.join(_mixed(some), "band")
    dealt = W.partitionBy("band").orderBy(F.xxhash64("band", "a", "b"), "a", "b")
    met = [F.lag(F.struct("a", "b", "root"), k).over(dealt).alias(f"x{k}") for k in range(1, MET + 1)]
    some = some.select("a", "b", "root", *met).select("a", "b", "root", F.explode(F.array(*(f"x{k}" for k in range(1, MET + 1)))).alias("x")).filter("x IS NOT NULL AND root != x.root")
    some = some.select(F.col("a").alias("a1"), F.col("b").alias("b1"), F.col("x.a").alias("a2"), F.col("x.b").alias("b2"), F.col("root").alias("root1"), F.col("x.root").alias("root2")).distinct()
    for end in "12":
        some = some.join(_ended(sketches, end, "a", "b", *_SKETCH), [f"a{end}", f"b{end}"])
    some = some.filter(_likely("1", "2")).select("a1", "b1", "a2", "b2", "root1", "root2")
    some = _keep(_verified(some, texts).select("root1", "root2").distinct(), "met")
    between = _keep(components(some, "root1", "root2"), "between")
    # roots of the first step that are under others now are nodes, too
    roots = _under(roots, between).unionAll(between.select("node.a", "node.b", "root"))
    roots = _keep(roots, "roots")
    placed = _keep(_under(placed, between), "placed")
    mixed = _mixed(placed)
    parts = F.ceil(F.col("n") / PART).cast("int")
    dealt = placed.join(mixed, "band").withColumns({"parts": parts, "part": F.pmod(F.xxhash64("a", "b"), parts).cast("int")}).drop("n")
    dealt = dealt.join(sketches.drop("low", "met"), ["a", "b"]).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    kept = ["part", "root", "a", "b", *_SKETCH, *_KEYS]
    dealt = dealt.select("band", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), *kept)
    dealt = _keep(dealt, "dealt")
    left, right = (dealt.select("band", "lo", "hi", *(F.col(c).alias(f"{c}{end}") for c in kept)) for end in "12")
    once = (F.col("lo") == F.col("hi")) | (F.col("part1") != F.col("part2"))
    order = (F.col("a1") < F.col("a2")) | ((F.col("a1") == F.col("a2")) & (F.col("b1") < F.col("b2")))
    shared = F.coalesce(*(F.when(F.col(f"{k}1") == F.col(f"{k}2"), F.col(f"{k}1")) for k in _KEYS))
    apart = order & (F.col("root1") != F.col("root2")) & once & (shared == F.col("band"))
    rest = left.join(right, ["band", "lo", "hi"]).filter(apart & _likely("1", "2"))
    rest = _keep(rest.select("a1", "b1", "a2", "b2", "root1", "root2"), "candidates")
    return roots, components(_verified(rest, texts).select("root1", "root2"), "root1", "root2")


def line_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(node, kept, class)`` for every line with a word: the line that stands for it, itself if it stays.

    Equal lines are one, the first by document and place. Different ones are linked if their
    shingle sets have similarity ``SIMILARITY``; all pairs that share a band are candidates.
    A class is what links connect and its first line is kept. Lines are told apart by their
    hashes (``a, b``), not by ``node``, which rows that share an id share too.
    """
    rows = _named(lines(docs, key, text))
    bands = materialize(banded(rows), "lines", shuffles=False)
    roots, higher = _links(bands, rows)
    higher = higher.select(F.col("node").alias("root"), F.col("root").alias("top"))
    tops = roots.join(higher, "root", "left").select("a", "b", F.coalesce("top", "root").alias("class"))
    # roots of the first step that the second one put under others
    own = higher.join(roots.select("a", "b"), (F.col("root.a") == F.col("a")) & (F.col("root.b") == F.col("b")), "left_anti")
    tops = tops.unionAll(own.select("root.a", "root.b", F.col("top").alias("class")))
    first = rows.groupBy("a", "b").agg(F.min("node").alias("first"))
    named = first.join(tops, ["a", "b"], "left").select("a", "b", "first", F.coalesce("class", F.struct("a", "b")).alias("class"))
    named = named.select("a", "b", "class", F.min("first").over(W.partitionBy("class")).alias("kept"))
    return rows.select("node", "a", "b").join(named, ["a", "b"]).select("node", "kept", "class")


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_lines, n_removed, removed)`` per id: lines with a word, and places of those that go.

    Rows that share an id count as one document; of a class's lines at its first document
    and place one stays. Documents without a line with a word have zeros. Null texts have no
    lines, a null id is an id, empty input gives no rows.
    """
    classes = line_classes(docs, key, text)
    goes = F.col("node") != F.col("kept")
    per = classes.groupBy("node.doc").agg(
        F.count("*").alias("n_lines"),
        F.collect_list(F.when(goes, F.col("node.at"))).alias("gone"),
        F.sort_array(F.collect_list(F.when(~goes, F.struct("node.at", "class")))).alias("stay"),
    )
    again = F.filter("stay", lambda x, i: (i > 0) & (F.col("stay")[F.greatest(i - 1, F.lit(0))] == x))
    per = per.select("doc", "n_lines", F.sort_array(F.concat("gone", F.transform(again, lambda x: x["at"]))).alias("removed"))
    ids = docs.select(F.col(key).cast("long").alias("doc_id")).distinct()
    out = ids.join(per, F.col("doc_id").eqNullSafe(F.col("doc")), "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return out.select("doc_id", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.size(removed).cast("long").alias("n_removed"), removed.alias("removed"))
