"""Tile products bring tiles to their partners in strips: no tile is repeated for each partner."""

from __future__ import annotations

import functools

import pytest
from pyspark.sql import functions as F

import sparsemat as sm
from test_plans import plan, setting
from test_sizes import cells
from test_stored import as_dict, product

PRODUCTS = {
    "summed": lambda a, b: sm.block_matmul(a, b, 32, 256, 7),
    "large tiles": lambda a, b: sm.block_matmul(a, b, 64, 512, 8, duplicates="unique", kernel="tiles"),
    "small tiles": lambda a, b: sm.block_matmul(a, b, 17, 70, 4, duplicates="unique"),
    "repeated": lambda a, b: sm.block_matmul(a, b, 32, 256, 7, duplicates="unique"),
    "grid": lambda a, b: sm.grid_matmul(a, b, 64, 512, 8, (4, 1, 2), duplicates="unique"),
}


@pytest.fixture
def factors(spark):
    """Many nearly empty tiles of A beside full ones of B, as of suppliers, parts and line numbers."""
    a = cells(spark, 20_000, "i", "k", 4000, 12_800, 51).withColumn("v", F.col("i") % 7 - 3)
    b = cells(spark, 40_000, "k", "j", 12_800, 7, 52).withColumn("v", F.col("j") % 5 - 2)
    return a.localCheckpoint(), b.localCheckpoint()


@pytest.mark.parametrize("name", PRODUCTS)
def test_tiles_are_not_repeated_for_each_partner(spark, factors, monkeypatch, name):
    given, frame = [], type(factors[0])
    kernel = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda self, *a, **b: given.append(self) or kernel(self, *a, **b))
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        c = PRODUCTS[name](*factors)
        lines = plan(c, "simple").splitlines()
        arrays = [F.size(n) for n, t in given[0].dtypes if t.startswith("array")]
        met = given[0].agg(F.sum(functools.reduce(lambda x, y: x + y, arrays))).first()[0]
    # four rows of a grid ask for four copies of B
    assert met <= 4 * sum(f.count() for f in factors)
    at, join = (next(n for n, line in enumerate(lines) if word in line) for word in ("MapInArrow", "Join"))
    assert not any("Exchange" in line for line in lines[at:join])
    assert as_dict(c) == product(*factors)


@pytest.mark.parametrize("scale", [1, 2**25, 2**27])
def test_full_and_nearly_empty_tiles_in_one_strip(spark, scale):
    """Full tiles meet one by one in arrays, the others all at once; sums are exact beyond 2^53."""
    full = spark.range(64 * 64).select((F.col("id") % 64 + 1).alias("r"), (F.expr("id div 64") + 1).alias("c"), (F.col("id") % 11 - 5).alias("v"))
    thin_a = cells(spark, 300, "i", "k", 640, 128, 53)
    thin_b = cells(spark, 300, "k", "j", 128, 640, 54)
    a = full.toDF("i", "k", "v").unionByName(thin_a.withColumn("i", F.col("i") + 64)).withColumn("v", F.col("v") * scale)
    b = full.toDF("k", "j", "v").unionByName(thin_b.withColumn("j", F.col("j") + 64)).withColumn("v", F.col("v") * scale)
    assert as_dict(sm.block_matmul(a, b, 64, 64, 64)) == product(a, b)
