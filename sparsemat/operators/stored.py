"""Products of factors that are stored in the order of k, and products kept up to date.

Both are for factors that are multiplied more than once: the shuffle by k is paid when they
are stored, and a change costs what it touches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.writers import bucket_of, write_summed_partials
from .multiply import merge_partials, operand, partial_products, _product
from .skew import one_cell, slice_factors

_KEYS = ("k", "_ls", "_rs")


def store_factors(
    a: DataFrame, b: DataFrame, name: str, path: str, buckets: int, *, duplicates: str = "sum", mode: str = "errorifexists"
) -> None:
    """Save A and B as the tables ``<name>_a`` and ``<name>_b``, bucketed alike by k and sorted by it.

    `path` is a folder that all executors share. A k with a large part of the work is cut
    into slices first (see `skew`), and the slice is part of the bucket's key, so it fills
    several buckets and the tables can be joined as they lie.
    """
    left, right = slice_factors(
        operand(a, "i", "k", duplicates).withColumnRenamed("v", "av"),
        operand(b, "k", "j", duplicates).withColumnRenamed("v", "bv"),
        ["k"],
        left_cells=one_cell("av"),
        right_cells=one_cell("bv"),
        left_split=["i"],
        right_split=["j"],
    )
    for side, df in (("a", left), ("b", right)):
        # dealt out as the buckets are, so that each bucket is one file
        placed = df.repartition(buckets, *_KEYS)
        writer = placed.write.mode(mode).bucketBy(buckets, *_KEYS).sortBy(*_KEYS)
        writer.option("path", f"{path}/{side}").saveAsTable(f"{name}_{side}")


def stored_matmul(spark: SparkSession, name: str, *, zeros: str = "structural", wrap_int32: bool = False) -> DataFrame:
    """C = A * B of the factors that :func:`store_factors` saved: neither is shuffled again."""
    a, b = spark.table(f"{name}_a"), spark.table(f"{name}_b")
    products = a.join(b, list(_KEYS)).select("i", "j", _product("av", "bv", wrap_int32).alias("p"))
    return merge_partials(products, zeros=zeros, wrap_int32=wrap_int32)


def delta_products(a: DataFrame, b: DataFrame, da: DataFrame, db: DataFrame, *, skew: str = "auto") -> DataFrame:
    """``(k, i, j, p)`` of the change of A * B when `da` and `db` are added: dA*B + A*dB + dA*dB.

    Cells of a change are added to the factor's (a removed one has its value negated), and
    what is multiplied are the rows and columns of k that the changes touch.
    """
    a, da = operand(a, "i", "k", "unique"), operand(da, "i", "k", "sum")
    b, db = operand(b, "k", "j", "unique"), operand(db, "k", "j", "sum")
    # dA meets the new B, dB the old A: the three terms in two joins
    new_b = b.join(da.select("k").distinct(), "k", "left_semi").unionByName(db)
    old_a = a.join(db.select("k").distinct(), "k", "left_semi")
    by_a = partial_products(da, new_b, duplicates="unique", skew=skew)
    return by_a.unionByName(partial_products(old_a, db, duplicates="unique", skew=skew))


def update_partials(
    spark: SparkSession, path: str, buckets: int, a: DataFrame, b: DataFrame, da: DataFrame, db: DataFrame
) -> list[int]:
    """Bring a store of `write_partials` up to date with changes of the factors; returns the rewritten buckets.

    The change is added to the stored products of the buckets that hold a changed k, and
    only these folders are replaced, all at the end of the job (dynamic partition
    overwrite): a lost executor leaves the store as it was, other files stay untouched.
    Their numbers, at most `buckets`, are all that comes to the driver.
    """
    bucket = bucket_of(buckets)
    touched = da.select(bucket).union(db.select(bucket)).distinct()
    numbers = sorted(r[0] for r in touched.collect())
    if not numbers:
        return []
    stored = spark.read.parquet(path).where(F.col("k_bucket").isin(numbers)).select("k", "i", "j", "p")
    change = delta_products(a, b, da, db).select("k", "i", "j", "p")
    write_summed_partials(stored.unionByName(change), path, buckets)
    return numbers
