"""Benchmark decontamination by winnowing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import skew_join
from .common import ALNUM, Words, gram_hashes, materialize, mix, ranges, slices, sliding_min, string_buffers, without

#: Words of a window: every shared span of so many words is found.
WINDOW = 13

#: Words of a k-gram, the unit of fingerprints.
GRAM = 5

#: Bits of the map of the benchmark's fingerprints that goes to the tasks (8 MiB, whatever the benchmark's size).
MAP_BITS = 1 << 26

#: Bits of one value of ``bitmap_construct_agg``.
_CHUNK = 1 << 15

#: Fingerprints that leave a task at once.
_ROWS = 1 << 15

_AROUND = pa.list_(pa.string())
_PRINT = "n int, print long, at long, back array<string>, fore array<string>"


def _kept(grams: np.ndarray, valid: np.ndarray, w: int) -> np.ndarray:
    """Which k-grams winnowing keeps: those that are the least of some valid run of ``w`` (each of equal ones)."""
    low = np.where(valid, sliding_min(grams, w), np.uint64(0))
    edge = np.zeros(w - 1, np.uint64)
    most = ~sliding_min(~np.concatenate([edge, low, edge]), w)
    return most == grams


def _prints(words: Words, n: int, gram: int, wanted: np.ndarray | None = None, bits: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, list]]:
    """``(text, arrays)`` of the fingerprints for windows of ``n`` words, some at a time.

    ``arrays`` are the columns of ``_PRINT``: the hash, the k-gram's first word, the words before
    it (nearest first) and those from it on, as far as a window around it reaches. ``wanted``
    chooses texts, ``bits`` is a map of the hashes to keep.
    """
    k = min(gram, n)
    if len(words) < n:
        return
    grams = gram_hashes(words.hashes(), k)
    text = np.repeat(np.arange(len(words.of) - 1), np.diff(words.of))
    valid = text[: len(text) - n + 1] == text[n - 1 :]
    if wanted is not None:
        valid &= wanted[text[: len(valid)]]
    prints = mix(grams + np.uint64(n))
    kept = np.flatnonzero(_kept(grams, valid, n - k + 1))
    if bits is not None:
        slot = prints[kept] & np.uint64(len(bits) * 8 - 1)
        kept = kept[(bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1]
    for at in np.split(kept, range(_ROWS, len(kept), _ROWS)) if len(kept) else ():
        own = text[at]
        before = np.minimum(n - k, at - words.of[own])
        after = np.minimum(n, words.of[own + 1] - at)
        first = np.cumsum(before) - before
        back = np.repeat(at - 1 + first, before) - np.arange(int(before.sum()))
        yield own, [
            pa.array(np.full(len(at), n, np.int32)),
            pa.array(prints[at].view(np.int64)),
            pa.array(at - words.of[own]),
            _lists(words, back, before),
            _lists(words, ranges(at, after), after),
        ]


def _lists(words: Words, which: np.ndarray, count: np.ndarray) -> pa.Array:
    """Lists of ``count`` words each, taken from the words numbered ``which``."""
    length = (words.end - words.start)[which]
    end = np.cumsum(length)
    data = words.data[ranges(words.start[which], length)]
    text = pa.Array.from_buffers(pa.string(), len(which), [None, pa.py_buffer(np.r_[0, end].astype(np.int32)), pa.py_buffer(data)])
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count)].astype(np.int32)), text)


def _cut(column: pa.Array) -> Words:
    return Words(*string_buffers(column), ALNUM, lower=True)


def _index(window: int, gram: int):
    """Benchmark texts -> their fingerprints, with windows as long as the item where it is shorter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = _cut(part.column("text"))
                size = np.minimum(np.diff(words.of), window)
                for n in np.unique(size[size > 0]).tolist():
                    for own, arrays in _prints(words, n, gram, wanted=size == n):
                        items = part.column("item").take(pa.array(own))
                        yield pa.RecordBatch.from_arrays([items, *arrays], ["item", "n", "print", "at", "back", "fore"])

    return run


def _scan(lengths: list[int], gram: int, bits):
    """Documents -> a head for each, and those of its fingerprints that the benchmark may have."""
    names = ["row", "key", "n_words", "n", "print", "at", "back", "fore"]
    blank = [pa.int32(), pa.int64(), pa.int64(), _AROUND, _AROUND]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = _cut(part.column("text"))
                head = [part.column("row"), part.column("key"), pa.array(np.diff(words.of))]
                yield pa.RecordBatch.from_arrays([*head, *(pa.nulls(part.num_rows, t) for t in blank)], names)
                for n in lengths:
                    for own, arrays in _prints(words, n, gram, bits=bits.value):
                        head = [part.column("row").take(pa.array(own)), pa.nulls(len(own), part.column("key").type), pa.nulls(len(own), pa.int64())]
                        yield pa.RecordBatch.from_arrays([*head, *arrays], names)

    return run


def _map(prints: DataFrame) -> np.ndarray:
    """Bitmap of the fingerprints: at most ``MAP_BITS`` bits come to the driver."""
    slot = F.col("print").bitwiseAND(F.lit(MAP_BITS - 1))
    rows = prints.select(F.floor(slot / _CHUNK).alias("c"), (slot % _CHUNK).alias("p"))
    out = np.zeros(MAP_BITS // 8, np.uint8)
    for c, chunk in rows.groupBy("c").agg(F.bitmap_construct_agg("p")).collect():
        out[c * _CHUNK // 8 : (c + 1) * _CHUNK // 8] = np.frombuffer(chunk, np.uint8)
    return out


def _alike(a: str, b: str) -> Column:
    """Number of leading words that two lists share."""
    first = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(False))
    return F.when(first > 0, first - 1).otherwise(F.size(a).cast("long"))


def _spans(found: DataFrame) -> DataFrame:
    """``(row, spans)``: the words of each row in any of its stretches, as disjoint spans in order.

    Windows, sums and lists all go by row and share one exchange. A row has at most as many
    stretches as it has words.
    """
    stretches = found.groupBy("row", "first").agg(F.max("stop").alias("stop"))
    order = Window.partitionBy("row").orderBy("first")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = stretches.withColumn("new", F.coalesce(F.col("first") > before, F.lit(True)).cast("long"))
    marked = marked.withColumn("span", F.sum("new").over(order))
    spans = marked.groupBy("row", "span").agg(F.min("first").alias("first"), F.max("stop").alias("stop"))
    one = F.struct("first", (F.col("stop") - F.col("first")).alias("length"))
    return spans.groupBy("row").agg(F.sort_array(F.collect_list(one)).alias("spans"))


def hits(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``(row, key, n_words, spans, items)``: the words of each row of ``docs`` that occur in the benchmark.

    ``spans``: disjoint ``(first, length)`` in words; ``items``: the items with occurring
    windows, sorted.

    Winnowing keeps the least k-gram hash of each window (of each window of an item's own length,
    if that is shorter), so a window that both sides have keeps the same k-gram in both.
    Fingerprints are joined on their hash. Each carries the words around it that a window can
    reach; a pair is a hit if the words that agree to both sides of the k-gram make a window, which
    compares words, not hashes.

    Documents are read once and their texts are never shuffled: a bitmap of fixed size keeps
    fingerprints that the benchmark lacks from travelling, and what is left is joined with hot
    fingerprints split. Nothing that grows with either table comes to the driver.
    """
    spark = docs.sparkSession
    bench = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    bench = bench.filter("text IS NOT NULL AND item IS NOT NULL").mapInArrow(_index(window, gram), f"item string, {_PRINT}")
    bench = materialize(bench, "benchmark-prints")
    lengths = [r[0] for r in bench.select("n").distinct().collect()]  # at most `window` numbers
    bits = spark.sparkContext.broadcast(_map(bench))

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    shape = f"row long, key {docs.schema[key].dataType.simpleString()}, n_words long, {_PRINT}"
    scanned = materialize(rows.mapInArrow(_scan(sorted(lengths), gram, bits), shape), "document-prints")
    heads = scanned.filter("n IS NULL").select("row", "key", "n_words")

    theirs = bench.groupBy("n", "print", "item", F.col("back").alias("back2"), F.col("fore").alias("fore2")).agg(F.min("at").alias("at2"))
    pairs = skew_join(
        scanned.filter("n IS NOT NULL").select("n", "print", "row", "at", "back", "fore"),
        theirs,
        ["n", "print"],
        left_cells=F.lit(1),
        right_cells=F.lit(1),
        left_split=["row", "at"],
        right_split=["item", "at2"],
    )
    pairs = pairs.select("row", "item", "n", "at", _alike("back", "back2").alias("b"), _alike("fore", "fore2").alias("f"))
    pairs = pairs.filter(f"f >= least(n, {int(gram)}) AND b + f >= n")
    found = pairs.select("row", "item", (F.col("at") - F.col("b")).alias("first"), (F.col("at") + F.col("f")).alias("stop"))
    found = materialize(found.distinct(), "hits")
    items = found.groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    out = heads.join(_spans(found), "row", "left").join(items, "row", "left")
    empty = {"spans": "array<struct<first:bigint,length:bigint>>", "items": "array<string>"}
    return out.withColumns({c: F.coalesce(c, F.array().cast(t)) for c, t in empty.items()})


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` for every row.

    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. A word
    is hit inside any occurrence of ``WINDOW`` consecutive words of an item (all words of a
    shorter item). Contaminated: some word and at least a twentieth of the words are hit.
    Null and word-less texts have no words and no hits; items without words match nothing.
    Benchmark rows without ``item_id`` aren't items, as in the SQL: their text gives no hits,
    and documents that hold it stay clean. Item ids are compared and sorted as strings.
    """
    found = hits(docs, benchmark, key)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["length"])
    rows = found.select(F.col("key").alias("doc_id"), "n_words", n_hit.alias("n_hit"), "items")
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated ones; rows that share a ``doc_id`` fall together, null ids stay."""
    gone = contamination(docs, benchmark).filter("contaminated AND doc_id IS NOT NULL").select("doc_id").distinct()
    return without(docs, gone)

