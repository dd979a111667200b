"""Conversions between matrix layouts.

A vector record is one Spark value and so lives in one task. To keep that bounded when
one row or column holds a large part of the matrix, records cover index *ranges*: the
entry with index ``x`` belongs to segment ``(x - 1) div width``, and a record never holds
more than `width` entries. A matrix no wider than `width` has one record per row.
Operators that read vectors accept any number of records per row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import DEFAULT_SEGMENT, DEFAULT_WIDTH, VECTOR, as_cells, require, resolve_duplicates
from .skew import SLICES_PER_TASK, deal, one_cell, shuffle_tasks, skew_join

# replicate() builds its index lists in chunks, so a list never holds more than this.
_CHUNK = 4096


def segment_of(index: str, width: int) -> Column:
    """0-based number of the index range that a 1-based index falls in."""
    return F.expr(f"(`{index}` - 1) div {int(width)}")


def entries(col: str, val: str) -> Column:
    """Aggregate of a vector, ordered by index."""
    return F.sort_array(F.collect_list(F.struct(F.col(col).alias("x"), F.col(val).alias("v"))))


def to_row_vectors(
    coo: DataFrame,
    row: str = "i",
    col: str = "k",
    val: str = "v",
    *,
    duplicates: str = "sum",
    width: int = DEFAULT_WIDTH,
) -> DataFrame:
    """Cells to ``(row, seg, vec)``, `vec` ordered by index and at most `width` long."""
    cells = resolve_duplicates(as_cells(coo, row, col, val), (row, col), duplicates, val)
    return (
        cells.withColumn("seg", segment_of(col, width))
        .groupBy(row, "seg")
        .agg(entries(col, val).alias("vec"))
    )


def to_column_vectors(
    coo: DataFrame,
    row: str = "i",
    col: str = "k",
    val: str = "v",
    *,
    duplicates: str = "sum",
    width: int = DEFAULT_WIDTH,
) -> DataFrame:
    """Cells to ``(col, seg, vec)`` with the row indices in `vec`."""
    return to_row_vectors(coo, col, row, val, duplicates=duplicates, width=width)


def from_row_vectors(rows: DataFrame, row: str = "i", col: str = "k", vec: str = "vec") -> DataFrame:
    """Vector records to cells."""
    return rows.select(F.col(row), F.inline(vec)).select(
        row, F.col("x").alias(col), F.col("v")
    )


def transpose(coo: DataFrame, row: str = "i", col: str = "k", val: str = "v") -> DataFrame:
    """Swap the roles of the two indices: names stay, contents change sides."""
    return coo.select(F.col(col).alias(row), F.col(row).alias(col), F.col(val))


def tag_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """Both inputs in one frame, keyed by the shared index: ``(k, tag, idx, v)``.

    A cells carry tag 0 and their row, B cells tag 1 and their column.
    """
    left = a.select("k", F.lit(0).alias("tag"), F.col("i").alias("idx"), "v")
    right = b.select("k", F.lit(1).alias("tag"), F.col("j").alias("idx"), "v")
    return left.unionByName(right)


def _pieces(coo, key, index, name, seg, duplicates, width):
    vectors = to_row_vectors(coo, key, index, duplicates=duplicates, width=width)
    return vectors.select(key, F.col("seg").alias(seg), F.col("vec").alias(name))


# Slices over which the cells of one k are spread while they learn its number of segments.
_SLICES = 64


def _by_degree(a, b, la, lb, duplicates, task):
    """Pairs ``(k, sa, sb, av, bv)`` of segments in numbers that the cells of each k call for.

    A histogram of both sides is summed by k. Only a k with more than `la` or `lb` cells is
    cut, into as many parts as these sizes ask for; a cell's part is a hash of its index.
    There are at most 1/la (1/lb) as many such k as cells. Each segment is repeated for the
    other side's segments, so a pair meets under a key of its own, and a hot k is as many
    small keys as it has pairs: nothing is left to be skewed.
    """
    a = resolve_duplicates(as_cells(a, "i", "k"), ("i", "k"), duplicates)
    b = resolve_duplicates(as_cells(b, "k", "j"), ("k", "j"), duplicates)
    none = F.lit(0).cast("bigint")
    count = one_cell("v").cast("bigint")
    cells = a.select("k", count.alias("na"), none.alias("nb")).unionByName(
        b.select("k", none.alias("na"), count.alias("nb"))
    )
    degrees = cells.groupBy("k").agg(F.sum("na").alias("na"), F.sum("nb").alias("nb"))
    one = F.lit(1).cast("bigint")
    long = degrees.where((F.col("na") > la) | (F.col("nb") > lb)).select(
        "k",
        F.greatest(one, F.ceil(F.col("na") / la)).alias("_pa"),
        F.greatest(one, F.ceil(F.col("nb") / lb)).alias("_pb"),
        F.explode(F.sequence(none, F.lit(_SLICES - 1))).alias("_s"),
    )

    def cut(side, index, own, other, name, seg, other_seg):
        sized = side.withColumn("_s", F.pmod(F.xxhash64(index), F.lit(_SLICES))).join(long, ["k", "_s"], "left")
        part = F.pmod(F.xxhash64(index, F.lit(seg)), F.coalesce(own, one))
        sized = sized.withColumn(seg, part).withColumn("_n", F.coalesce(other, one))
        segments = sized.groupBy("k", seg, "_n").agg(entries(index, "v").alias(name))
        return segments.withColumn(other_seg, F.explode(F.sequence(none, F.col("_n") - 1))).drop("_n")

    av = cut(a, "i", "_pa", "_pb", "av", "sa", "sb")
    bv = cut(b, "j", "_pb", "_pa", "bv", "sb", "sa")
    keys = ["k", "sa", "sb"]
    if task is not None:
        tasks = shuffle_tasks(a)
        av, bv = (deal(side, tasks, task, F.xxhash64(*keys)) for side in (av, bv))
        keys = [task, *keys]
    return av.join(bv, keys)


def _outer(a, b, la, lb, how, duplicates, skew, by="range", task=None):
    require(by, ("range", "degree"), "by")
    if by == "degree":
        return _by_degree(a, b, la, lb, duplicates, task)
    return skew_join(
        _pieces(a, "k", "i", "av", "sa", duplicates, la),
        _pieces(b, "k", "j", "bv", "sb", duplicates, lb),
        ["k"],
        how,
        left_cells=F.size("av"),
        right_cells=F.size("bv"),
        left_split=["sa"],
        right_split=["sb"],
        skew=skew,
        task=task,
    )


def cogroup_outer(
    a: DataFrame,
    b: DataFrame,
    *,
    la: int = DEFAULT_SEGMENT,
    lb: int = DEFAULT_SEGMENT,
    duplicates: str = "sum",
    skew: str = "auto",
) -> DataFrame:
    """A's column k beside B's row k: ``(k, sa, sb, n, av, bv)``, `n` = entries of `av`.

    A k found on one side only is kept, with an empty vector (and segment 0) on the other.
    A column longer than `la` or a row longer than `lb` appears as one record per pair
    of segments.
    """
    empty = F.array().cast(VECTOR)
    zero = F.lit(0).cast("bigint")
    return (
        _outer(a, b, la, lb, "full", duplicates, skew)
        .withColumn("av", F.coalesce("av", empty))
        .withColumn("bv", F.coalesce("bv", empty))
        .select(
            "k",
            F.coalesce("sa", zero).alias("sa"),
            F.coalesce("sb", zero).alias("sb"),
            F.size("av").cast("bigint").alias("n"),
            "av",
            "bv",
        )
    )


def segment_pairs(
    a: DataFrame,
    b: DataFrame,
    la: int = DEFAULT_SEGMENT,
    lb: int = DEFAULT_SEGMENT,
    *,
    duplicates: str = "sum",
    skew: str = "auto",
    by: str = "range",
    task: str | None = None,
) -> DataFrame:
    """Every pair of a segment of A's column k and a segment of B's row k.

    ``(k, sa, sb, n, av, bv)``; k must be on both sides, and an empty segment makes no pair.
    ``by="range"``: a segment covers `la` (`lb`) indices, so sparse columns fall into many
    short ones. ``by="degree"``: each k has as many segments as its own cells fill, `la`
    (`lb`) in each on average, and a short column or row stays whole; segment numbers then
    say nothing about indices. `task` is that of :func:`skew_join`.
    """
    pairs = _outer(a, b, la, lb, "inner", duplicates, skew, by, task)
    kept = [task] if task else []
    return pairs.select("k", "sa", "sb", F.size("av").cast("bigint").alias("n"), "av", "bv", *kept)


def scaled_rows(
    a: DataFrame,
    b: DataFrame,
    *,
    duplicates: str = "sum",
    width: int = DEFAULT_WIDTH,
    skew: str = "auto",
    task: str | None = None,
) -> DataFrame:
    """Each A cell with B's row k: ``(i, k, p, bv)``, `p` the cell's value.

    A cell without a B row keeps an empty vector; a B row that no A cell asks for is gone.
    `task` is that of :func:`skew_join`.
    """
    cells = resolve_duplicates(as_cells(a, "i", "k"), ("i", "k"), duplicates)
    joined = skew_join(
        cells.select("i", "k", F.col("v").alias("p")),
        _pieces(b, "k", "j", "bv", "sb", duplicates, width),
        ["k"],
        "left",
        left_cells=one_cell("p"),
        right_cells=F.size("bv"),
        left_split=["i"],
        right_split=["sb"],
        skew=skew,
        task=task,
    )
    kept = [task] if task else []
    return joined.select("i", "k", "p", F.coalesce("bv", F.array().cast(VECTOR)).alias("bv"), *kept)


def split_halves(df: DataFrame, acol: int, key: str = "k") -> DataFrame:
    """Add ``half``: "A" for the lower half of ``1..acol``, else "B"."""
    lower = F.col(key) <= F.expr(f"{int(acol)} div 2")
    return df.withColumn("half", F.when(lower, "A").otherwise("B"))


def to_blocks(
    coo: DataFrame,
    row: str,
    col: str,
    row_size: int,
    col_size: int,
    names: Sequence[str] = ("ib", "kb", "il", "kl"),
    val: str = "v",
) -> DataFrame:
    """1-based cells to 0-based tile address ``(ib, kb)`` and place in the tile ``(il, kl)``."""
    rb, cb, rl, cl = names
    return coo.select(
        segment_of(row, row_size).alias(rb),
        segment_of(col, col_size).alias(cb),
        F.pmod(F.col(row) - 1, F.lit(int(row_size))).alias(rl),
        F.pmod(F.col(col) - 1, F.lit(int(col_size))).alias(cl),
        val,
    )


def from_blocks(
    tiles: DataFrame,
    row: str,
    col: str,
    row_size: int,
    col_size: int,
    names: Sequence[str] = ("ib", "kb", "il", "kl"),
    val: str = "v",
) -> DataFrame:
    """Tile addresses back to 1-based cells."""
    rb, cb, rl, cl = names
    return tiles.select(
        (F.col(rb) * int(row_size) + F.col(rl) + 1).alias(row),
        (F.col(cb) * int(col_size) + F.col(cl) + 1).alias(col),
        val,
    )


def replicate(df: DataFrame, n: int, name: str) -> DataFrame:
    """Every row n times, numbered ``1..n`` in column `name`."""
    chunks = F.explode(F.expr(f"sequence(0L, ({int(n)}L - 1) div {_CHUNK})"))
    start = F.col("_chunk") * _CHUNK
    within = F.explode(
        F.sequence(start + 1, F.least(start + _CHUNK, F.lit(int(n)).cast("bigint")))
    )
    if n < 1:
        return df.withColumn(name, F.lit(None).cast("bigint")).where(F.lit(False))
    return df.withColumn("_chunk", chunks).withColumn(name, within).drop("_chunk")


def gather_blocks(pairs: DataFrame, row_block: str, col_block: str, inner: str, task: str | None = None) -> DataFrame:
    """Lay the pairs that add to one block of C side by side.

    Unfolded in the order of k, pairs touch all of C at once: sums made before the shuffle
    find few partners and their hash table outgrows the caches. Side by side, a task works
    on one block of C at a time. A block is dealt out in slices of k, so one with many pairs
    is work for many tasks, and its parts are summed later. Hashes need no sample of the
    join that made the pairs. The number of partitions is given because merging partitions
    by their bytes would be wrong here: the work of a pair is the product of its sides.
    `task` names a further column with the number of the partition; sums by it stay in place.
    """
    tasks = shuffle_tasks(pairs)
    slices = F.lit(max(1, math.isqrt(SLICES_PER_TASK * tasks)))
    place = (row_block, col_block, F.pmod(F.xxhash64(inner), slices))
    dealt = deal(pairs, tasks, task, F.xxhash64(*place)) if task else pairs.repartition(tasks, *place)
    return dealt.sortWithinPartitions(row_block, col_block, inner)


def sorted_by(df: DataFrame, *keys: str) -> DataFrame:
    """Range-partition on the composite key and sort inside each partition.

    Ranges are cut on the whole key, so the rows of one hot leading key may fill several
    neighbouring partitions and still come out in order.
    """
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def nnz(coo: DataFrame) -> DataFrame:
    """Number of stored cells, as a one-row frame ``(nnz)``."""
    return coo.agg(F.count(F.lit(1)).alias("nnz"))
