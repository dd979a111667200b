"""Data model: matrices as DataFrames of integer cells, and what may go wrong in them.

A matrix is a DataFrame of cells ``(row, col, v)`` with 1-based BIGINT indices and
a BIGINT value; an absent cell is 0. By convention A is ``(i, k, v)``, B is
``(k, j, v)`` and a product C is ``(i, j, v)``. A sparse vector is an
``ARRAY<STRUCT<x BIGINT, v BIGINT>>`` ordered by ``x`` that holds each ``x`` once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTRY = T.StructType([T.StructField("x", T.LongType()), T.StructField("v", T.LongType())])
VECTOR = T.ArrayType(ENTRY)

# Longest index range one vector record may span; see operators.layout.
DEFAULT_WIDTH = 65536
# Shorter ranges for records whose two sides get multiplied with each other. On dense
# factors 256 is faster still (a block of C then fits the caches), on thin ones 4096.
DEFAULT_SEGMENT = 1024

DUPLICATES = ("sum", "max", "error", "unique")
ZEROS = ("structural", "drop", "dense_support")


def coo_schema(row: str, col: str, val: str = "v") -> T.StructType:
    """Schema of a matrix in coordinate form."""
    return T.StructType([T.StructField(n, T.LongType()) for n in (row, col, val)])


def require(value: str, allowed: Sequence[str], what: str) -> str:
    if value not in allowed:
        raise ValueError(f"{what} must be one of {', '.join(allowed)}, not {value!r}")
    return value


def assert_rows(df: DataFrame, ok: Column, message: Column) -> DataFrame:
    """Pass every row on, or fail the query with `message` where `ok` does not hold."""
    failure = F.raise_error(message).cast("boolean")
    return df.where(F.when(ok, F.lit(True)).otherwise(failure))


def as_cells(df: DataFrame, row: str, col: str, val: str = "v") -> DataFrame:
    """Select the three cell columns and widen them to BIGINT."""
    return df.select(*(F.col(n).cast("bigint").alias(n) for n in (row, col, val)))


def check_bounds(df: DataFrame, **limits: int | None) -> DataFrame:
    """Fail on an index outside ``1..limit``; ``check_bounds(a, i=4, k=3)``."""
    for name, limit in limits.items():
        if limit is not None:
            df = assert_rows(
                df,
                F.col(name).between(1, limit),
                F.concat(F.lit(f"index {name} outside 1..{limit}: "), F.col(name).cast("string")),
            )
    return df


def resolve_duplicates(df: DataFrame, keys: Sequence[str], policy: str, val: str = "v") -> DataFrame:
    """One cell per key. Pre-aggregates before its shuffle, so copies cost nothing there.

    ``sum`` adds copies, ``max`` picks the largest, ``error`` fails on the first one.
    ``unique`` trusts the caller that there are none and does not shuffle.
    """
    require(policy, DUPLICATES, "duplicates")
    if policy == "unique":
        return df
    if policy == "error":
        counted = df.groupBy(*keys).agg(F.max(val).alias(val), F.count(F.lit(1)).alias("_n"))
        where = F.concat_ws(",", *(F.col(k).cast("string") for k in keys))
        counted = assert_rows(
            counted, F.col("_n") == 1, F.concat(F.lit(f"duplicate cell {tuple(keys)}: "), where)
        )
        return counted.drop("_n")
    pick = F.sum if policy == "sum" else F.max
    return df.groupBy(*keys).agg(pick(val).alias(val))


def wrap_int32(value: Column) -> Column:
    """The value a 32-bit two's complement register would hold."""
    half, full = 2147483648, 4294967296
    return F.pmod(F.pmod(value, F.lit(full)) + half, F.lit(full)) - half
