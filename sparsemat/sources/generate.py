"""Reproducible random sparse matrices.

Whether a cell is kept, and its value, are read off a hash of (seed, i, j), so a matrix
is the same however Spark partitions it and whenever a lost task is run again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import shuffle_tasks

_HASH_RANGE = 4294967296  # numbers that 8 hex digits can hold


def _hex_number(digest: Column, start: int) -> Column:
    return F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")


def generate_sparse(
    spark: SparkSession,
    m: int,
    n: int,
    density: float,
    seed: int = 0,
    *,
    max_value: int = 100,
    names: tuple[str, str] = ("i", "k"),
    partitions: int | None = None,
) -> DataFrame:
    """An m x n matrix: each cell is kept with probability `density`.

    Values are uniform in ``0 .. max_value-1``; explicit zeros occur. Indices are 1-based.
    Every cell is looked at, so that whether it is kept depends on its own hash alone; for a
    thin matrix :func:`sample_rows` makes the kept cells only.
    """
    if not 0.0 <= density <= 1.0:
        raise ValueError("density must lie in 0..1")
    grid = spark.range(0, m * n, 1, partitions).select(
        (F.expr(f"id div {int(n)}") + 1).alias(names[0]),
        (F.pmod("id", F.lit(int(n))) + 1).alias(names[1]),
    )
    return sample_cells(grid, density, seed, max_value=max_value)


# Cells that a block of columns holds on average when only kept cells are made.
_PER_BLOCK = 16

# Blocks that are numbered in one array.
_CHUNK = 4096


def count_thresholds(n: int, density: float) -> list[int]:
    """Integers t with: a 32-bit number u is at least so many of them as a Binomial(n, density) draw.

    The sum of probabilities is rounded to 32 bits; what is rarer than 2^-32 does not occur.
    """
    if density <= 0.0 or n == 0:
        return []
    if density >= 1.0:
        return [0] * n
    total, out = 0.0, []
    for x in range(n + 1):
        log = math.lgamma(n + 1) - math.lgamma(x + 1) - math.lgamma(n - x + 1)
        total += math.exp(log + x * math.log(density) + (n - x) * math.log1p(-density))
        threshold = round(total * _HASH_RANGE)
        if threshold >= _HASH_RANGE:
            break
        out.append(threshold)
    return out[:n]


def block_width(density: float) -> int:
    """Columns of a block in :func:`sample_rows`."""
    return max(_PER_BLOCK, math.ceil(_PER_BLOCK / density)) if density > 0.0 else 1 << 40


def sample_rows(
    rows: DataFrame, n: int, density: float, seed: int = 0, *, max_value: int = 100, col: str = "k"
) -> DataFrame:
    """A random row of `n` columns for each number in the one column of `rows`.

    Like :func:`sample_cells`, each cell is kept with probability `density` independently of
    the others, but only kept cells are made: per row and block of columns a hash gives the
    number of cells (by thresholds of the binomial distribution), and further hashes their
    places without repetition. The work grows with the cells that are kept.
    """
    (row,) = rows.columns
    width = block_width(density)
    last = (n - 1) // width  # number of the last block, which may be narrower
    # numbered in chunks, so that no array grows with n
    zero = F.lit(0).cast("bigint")
    # A row's number is a few bytes, its cells are the work: one file of numbers is work for many tasks.
    rows = rows.repartition(shuffle_tasks(rows), row)
    chunks = rows.select(row, F.explode(F.sequence(zero, F.lit(last // _CHUNK))).alias("_chunk"))
    start = F.col("_chunk") * _CHUNK
    blocks = chunks.select(row, F.explode(F.sequence(start, F.least(start + _CHUNK - 1, F.lit(last)))).alias("_b"))

    def drawn(*parts: Column) -> Column:
        text = (F.lit(f"r{int(seed)}"), F.col(row).cast("string"), F.col("_b").cast("string"), *parts)
        return F.md5(F.concat_ws(",", *text))

    def below(limits: list[int]) -> Column:
        u = F.col("_u")
        return F.size(F.filter(F.array(*map(F.lit, limits)).cast("array<bigint>"), lambda t: t <= u))

    rest = n - last * width
    size = F.when(F.col("_b") == last, F.lit(rest)).otherwise(F.lit(width)).cast("bigint")
    count = F.when(F.col("_b") == last, below(count_thresholds(rest, density)))
    if last:
        count = count.otherwise(below(count_thresholds(width, density)))
    sized = blocks.withColumn("_u", _hex_number(drawn(), 1)).select(
        row, "_b", size.alias("_w"), count.cast("bigint").alias("_n")
    )

    def add(chosen: Column, j: Column) -> Column:
        # each step picks among the first j places; one that is taken gives way to j itself
        pick = F.pmod(_hex_number(drawn(j.cast("string")), 1), j) + 1
        return F.concat(chosen, F.array(F.when(F.array_contains(chosen, pick), j).otherwise(pick)))

    steps = F.sequence(F.col("_w") - F.col("_n") + 1, F.col("_w"))
    places = F.aggregate(steps, F.array().cast("array<bigint>"), add)
    cells = sized.where(F.col("_n") > 0).select(row, "_b", F.explode(places).alias("_x"))
    value = F.pmod(_hex_number(drawn(F.lit("v"), F.col("_x").cast("string")), 1), F.lit(int(max_value)))
    return cells.select(row, (F.col("_b") * width + F.col("_x")).alias(col), value.alias("v"))


def sample_cells(grid: DataFrame, density: float, seed: int, *, max_value: int = 100) -> DataFrame:
    """Keep each (row, col) of `grid` with probability `density` and give it a value."""
    row, col = grid.columns
    text = (F.lit(str(int(seed))), F.col(row).cast("string"), F.col(col).cast("string"))
    digest = F.md5(F.concat_ws(",", *text))
    kept = grid.where(_hex_number(digest, 1) < int(density * _HASH_RANGE))
    return kept.select(row, col, F.pmod(_hex_number(digest, 9), F.lit(int(max_value))).alias("v"))


def generate_pair(
    spark: SparkSession, m: int, n: int, density: float, seed: int = 0, **options
) -> tuple[DataFrame, DataFrame]:
    """A factor A (m x n) and a factor B (n x m) that can be multiplied."""
    return (
        generate_sparse(spark, m, n, density, seed, names=("i", "k"), **options),
        generate_sparse(spark, n, m, density, seed + 1, names=("k", "j"), **options),
    )


def sample_pair(
    rows: DataFrame, n: int, density: float, seed: int = 0, *, max_value: int = 100
) -> tuple[DataFrame, DataFrame]:
    """Factors A ``(i, k, v)`` and B ``(k, j, v)`` over the m numbers in the one column of `rows`.

    A has a random row of `n` columns for each number, B a random column of `n` rows; as in
    :func:`sample_rows` only the cells that are kept are made.
    """
    (row,) = rows.columns
    a = sample_rows(rows.select(F.col(row).alias("i")), n, density, seed, max_value=max_value)
    b = sample_rows(rows.select(F.col(row).alias("j")), n, density, seed + 1, max_value=max_value)
    return a, b.select("k", "j", "v")
