"""Mixing sources to target weights with Efraimidis-Spirakis keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fresh, materialize, n_words

#: Weights of the sources in order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)

#: A source gives at most so many times its size.
MOST = 3

#: Parts of the key's range in which a source's sizes are summed before one of them is sorted.
PARTS = 4096


def quality(text: Column, size: Column) -> Column:
    """Weight of a document: 1 without the symbols ``#*$%&|<>``, a half with one per word."""
    symbols = F.coalesce(F.regexp_count(text, F.lit("[#*$%&|<>]")), F.lit(0))
    return 1.0 / (1.0 + symbols / F.greatest(size, F.lit(1)))


def sampling_key(doc_id: Column, weight: Column, seed: str = "mix") -> Column:
    """-ln(u)/weight with u in (0, 1] from the MD5 of seed and id: taking the least keys samples by weight."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))), 1, 13)
    u = (F.conv(digits, 16, 10).cast("long") + 1) / F.lit(float(1 << 52))
    return -F.ln(u) / weight


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, one row a source.

    Sources by code point, null last, take the weights in turn and share the sum of all
    sizes. A target stops at ``most`` times its source's size; what is above is shared again
    by weight among the others until none is above. Every turn sends two sums to the driver.
    """
    # the place in order: rows before this range of sources, then the place within the range
    ordered = sizes.repartitionByRange(F.col("source").asc_nulls_last())
    ordered = materialize(ordered.withColumn("range", F.spark_partition_id()), "sources")
    before = ordered.groupBy("range").agg(F.count("*").alias("n"))
    before = before.select("range", (F.sum("n").over(W.orderBy("range")) - F.col("n")).alias("before"))
    place = F.row_number().over(W.partitionBy("range").orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = ordered.join(before, "range").withColumn("place", F.col("before") + place)
    turn = F.array(*(F.lit(float(w)) for w in weights))
    ranked = materialize(
        ranked.select("source", "source_size", F.get(turn, F.pmod("place", F.lit(len(weights))).cast("int")).alias("weight")),
        "weights",
    )
    cap = (most * F.col("source_size")).cast("double")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    share = 0.0
    while True:  # `share` per unit of weight only grows, so a source once at its cap stays there
        above = F.col("weight") * share > cap
        capped, open_ = ranked.agg(F.sum(F.when(above, most * F.col("source_size"))), F.sum(F.when(~above, F.col("weight")))).first()
        now = (total - (capped or 0)) / open_ if open_ else share
        if now <= share:
            break
        share = now
    return ranked.select("source", "source_size", F.least(F.col("weight") * share, cap).alias("target"))


def _keyed(docs: DataFrame, key: str, text: str, source: str, prefix: str) -> DataFrame:
    """``docs`` with the columns size, key and id that the cut is taken by."""
    df = docs.withColumn(f"{prefix}size", n_words(F.col(text).cast("string")))
    weight = quality(F.col(text).cast("string"), F.col(f"{prefix}size"))
    df = df.withColumn(f"{prefix}key", sampling_key(F.col(key), weight))
    df = df.withColumn(f"{prefix}id", F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)).cast("long")))
    return df.withColumn(f"{prefix}source", F.col(source).cast("string"))


def cuts(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row a source: ``source, source_size, target, epochs`` and where the last, partial epoch ends.

    Within a source documents stand by key, then id, then size. The target holds ``epochs``
    whole passes; what is left is taken from the front, the document at the cut in part
    (``cut_rest`` words of it; copies of that very row share them). The cut is found in two
    steps, sums of ``PARTS`` parts of the key's range and then one part in order, so no task
    sorts a whole source.
    """
    rows = _keyed(docs, key, text, source, "").select("source", "key", "id", "size")
    rows = rows.groupBy("source", "key", "id", "size").agg(F.count("*").alias("copies"))
    part = F.floor((1 - F.exp(-F.col("key"))) * PARTS)
    rows = materialize(rows.withColumn("part", part).withColumn("words", F.col("size") * F.col("copies")), "keys")
    sizes = rows.groupBy("source").agg(F.sum("words").alias("source_size"))
    goal = targets(sizes, weights, most)
    goal = goal.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.floor("target") / F.col("source_size"))).otherwise(0).cast("long"))
    goal = materialize(goal.withColumn("rest", F.floor("target") - F.col("epochs") * F.col("source_size")), "targets")
    sums = rows.groupBy("source", "part").agg(F.sum("words").alias("words"))
    sums = sums.withColumn("upto", F.sum("words").over(W.partitionBy("source").orderBy("part")))
    joined = sums.alias("s").join(goal.alias("g"), F.col("s.source").eqNullSafe(F.col("g.source")))
    at = joined.filter("s.upto > g.rest").groupBy("s.source", "g.rest").agg(F.min(F.struct("s.part", (F.col("s.upto") - F.col("s.words")).alias("before"))).alias("p"))
    at = at.select("source", "rest", "p.part", "p.before")
    inside = rows.alias("r").join(at.alias("a"), F.col("r.source").eqNullSafe(F.col("a.source")) & (F.col("r.part") == F.col("a.part")))
    order = W.partitionBy("source").orderBy("key", "id", "size")
    inside = inside.select("r.source", "key", "id", "size", "copies", "words", "rest", "before")
    inside = inside.withColumn("upto", F.col("before") + F.sum("words").over(order)).filter("upto > rest")
    cut = inside.groupBy("source").agg(F.min(F.struct("key", "id", "size", "copies", (F.col("rest") - F.col("upto") + F.col("words")).alias("rest"))).alias("cut"))
    out = goal.alias("g").join(cut.alias("c"), F.col("g.source").eqNullSafe(F.col("c.source")), "left")
    rest = F.floor(F.col("cut.rest") / F.col("cut.copies"))
    out = out.select("g.source", "source_size", "target", "epochs", F.struct("cut.key", "cut.id", "cut.size").alias("cut"), rest.alias("cut_rest"))
    return materialize(out, "cuts")


def _taken(docs: DataFrame, key: str, text: str, source: str, weights: Sequence[float], most: int, prefix: str) -> DataFrame:
    """``docs`` with prefixed columns size, source_size, target and taken."""
    found = cuts(docs, key, text, source, weights, most)
    found = found.select(*(F.col(c).alias(f"{prefix}{c}" if c != "source" else f"{prefix}of") for c in found.columns))
    df = _keyed(docs, key, text, source, prefix)
    df = df.join(found, F.col(f"{prefix}source").eqNullSafe(F.col(f"{prefix}of")), "left")
    place = F.struct(F.col(f"{prefix}key").alias("key"), F.col(f"{prefix}id").alias("id"), F.col(f"{prefix}size").alias("size"))
    cut = F.col(f"{prefix}cut")
    rest = F.when(cut["key"].isNull(), F.lit(0)).when(place < cut, F.col(f"{prefix}size")).when(place == cut, F.col(f"{prefix}cut_rest")).otherwise(0)
    return df.withColumn(f"{prefix}taken", (F.col(f"{prefix}epochs") * F.col(f"{prefix}size") + rest).cast("long"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` for every row of ``docs``.

    A size is a number of plain words (null: 0). Whole epochs of a source come first, then
    a fraction of one, sampled without replacement by quality weight. The words taken of a
    source are its target rounded down (but for the copies of the row at the cut, which
    share what is left evenly). Depends on nothing but the rows, so reruns agree. A null
    source is a source, a null id is an id; empty input gives no rows.
    """
    p = "_mix_"
    df = _taken(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.col(source).alias("source")), "doc_id", "text", "source", weights, most, p)
    return df.select("doc_id", *(F.col(f"{p}{c}").alias(c) for c in ("size", "source_size", "target", "taken")))


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mix itself: each document as often as it is taken, the last copy cut to its words.

    The sources' cuts are one row each, so texts are joined to them where they lie.
    A cut copy has its words joined by one space, the others their text as it is.
    """
    p = fresh(docs, "_mix_")
    df = _taken(docs, key, text, source, weights, most, p)
    size, taken = F.col(f"{p}size"), F.col(f"{p}taken")
    copies = F.when(taken > 0, F.ceil(taken / size)).otherwise(0).cast("int")
    copy = F.when(copies > 0, F.sequence(F.lit(1), F.greatest(copies, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    df = df.withColumn(f"{p}copy", F.explode(copy))
    words = F.least(size, taken - (F.col(f"{p}copy") - 1) * size)
    plain = F.filter(F.split(F.col(text).cast("string"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = F.when(words < size, F.array_join(F.slice(plain, F.lit(1), F.greatest(words, F.lit(1)).cast("int")), " ")).otherwise(F.col(text))
    return df.select(*(cut.alias(c) if c == text else F.col(c) for c in docs.columns))
