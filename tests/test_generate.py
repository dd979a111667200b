from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

import sparsemat as sm
from helpers import product, rows


def _expected(m, n, density, seed, max_value=100):
    out = []
    for i in range(1, m + 1):
        for j in range(1, n + 1):
            digest = hashlib.md5(f"{seed},{i},{j}".encode()).hexdigest()
            if int(digest[:8], 16) < int(density * 2**32):
                out.append((i, j, int(digest[8:16], 16) % max_value))
    return out


def test_cells_follow_the_hash(spark):
    ours = sm.generate_sparse(spark, 40, 30, 0.2, 42)
    assert ours.columns == ["i", "k", "v"]
    assert rows(ours) == _expected(40, 30, 0.2, 42)


def test_same_matrix_however_partitioned(spark):
    one = rows(sm.generate_sparse(spark, 25, 25, 0.3, 1, partitions=1))
    assert one == rows(sm.generate_sparse(spark, 25, 25, 0.3, 1, partitions=7))
    assert one != rows(sm.generate_sparse(spark, 25, 25, 0.3, 2))


def test_density_bounds_and_values(spark):
    assert rows(sm.generate_sparse(spark, 5, 5, 0.0)) == []
    full = sm.generate_sparse(spark, 50, 50, 1.0)
    low, high, zeros, n = full.agg(
        F.min("v"), F.max("v"), F.sum((F.col("v") == 0).cast("int")), F.count("*")
    ).first()
    assert (low, n) == (0, 2500) and 90 <= high <= 99 and zeros > 0
    assert sm.generate_sparse(spark, 20, 20, 1.0, max_value=3).agg(F.max("v")).first()[0] == 2
    with pytest.raises(ValueError):
        sm.generate_sparse(spark, 5, 5, 1.5)


def test_pair_multiplies(spark):
    a, b = sm.generate_pair(spark, 12, 9, 0.4, 5)
    assert (a.columns, b.columns) == (["i", "k", "v"], ["k", "j", "v"])
    assert rows(b) == _expected(9, 12, 0.4, 6)
    expected = product(rows(a), rows(b))
    assert rows(sm.matmul(a, b, duplicates="unique")) == expected
    assert rows(sm.block_matmul(a, b, 5, 4, 5, kernel="tiles")) == [c for c in expected if c[2]]


def test_thin_rows_hold_as_many_cells_as_they_should(spark):
    parts = spark.range(1, 401).withColumnRenamed("id", "i")
    for n, density in ((1000, 0.01), (5000, 0.002), (90, 0.3), (7, 1.0), (16, 0.5)):
        got = sm.sample_rows(parts, n, density, 3)
        low, high, count, places = got.agg(F.min("k"), F.max("k"), F.count("*"), F.countDistinct("i", "k")).first()
        expected = 400 * n * density
        assert 1 <= low and high <= n and count == places
        assert abs(count - expected) <= 5 * (expected * (1 - density)) ** 0.5
    assert sm.sample_rows(parts, 10, 0.0).count() == 0
    once = rows(sm.sample_rows(parts, 500, 0.05, 1))
    assert once == rows(sm.sample_rows(parts.repartition(5), 500, 0.05, 1))
    assert once != rows(sm.sample_rows(parts, 500, 0.05, 2))


def test_thin_rows_cover_columns_evenly(spark):
    parts = spark.range(1, 2001).withColumnRenamed("id", "i")
    per = sm.sample_rows(parts, 100, 0.1, 7).groupBy("k").count().collect()
    assert len(per) == 100
    assert all(130 <= r["count"] <= 275 for r in per)
