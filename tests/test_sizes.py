"""Estimated sizes, bitmaps of masks, counted lines and generated pairs."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import sparsemat as sm
from sparsemat.operators.multiply import mask_bits
from test_plans import plan, setting


def cells(spark, n, row, col, rows, cols, seed):
    """About n cells at hashed places."""
    place = lambda part, size: (F.pmod(F.xxhash64("id", F.lit(seed), F.lit(part)), F.lit(size)) + 1)
    made = spark.range(n).select(place("r", rows).alias(row), place("c", cols).alias(col))
    return made.distinct().withColumn("v", F.lit(1).cast("bigint"))


@pytest.mark.parametrize("skew", ["salt", "off"])
def test_size_of_wide_rows_is_within_four_errors(spark, skew):
    """Rows of C with about 4,000 of 20,000 columns: beyond what a sketch counts exactly."""
    a = cells(spark, 300, "i", "k", 30, 60, 1).cache()
    b = cells(spark, 40_000, "k", "j", 60, 20_000, 2).cache()
    found = sm.product_size(a, b, duplicates="unique", skew=skew).first()
    true = a.join(b, "k")
    assert (found.nnz_a, found.nnz_b, found.products) == (a.count(), b.count(), true.count())
    assert found.rows == true.select("i").distinct().count() and found.inner == b.select("k").distinct().count()
    assert abs(found.nnz_c / true.select("i", "j").distinct().count() - 1) < 4 * 2**-5
    assert abs(found.columns / b.select("j").distinct().count() - 1) < 4 * 2**-5


def test_size_of_narrow_rows_is_exact(spark):
    a, b = cells(spark, 3000, "i", "k", 200, 500, 3), cells(spark, 3000, "k", "j", 500, 900, 4)
    a = a.unionByName(spark.createDataFrame([(1, 900, 5)], a.schema))  # k without a row of B
    true = a.join(b, "k")
    assert sm.product_size(a, b).first().nnz_c == true.select("i", "j").distinct().count()
    none = a.limit(0)
    empty = sm.product_size(none, b).first()
    assert (empty.nnz_a, empty.products, empty.rows, empty.nnz_c) == (0, 0, 0, 0)


def test_methods_by_size(spark):
    thin = cells(spark, 500, "i", "k", 400, 400, 5), cells(spark, 500, "k", "j", 400, 400, 6)
    dense = cells(spark, 9000, "i", "k", 64, 64, 7), cells(spark, 9000, "k", "j", 64, 64, 8)
    flat = cells(spark, 4000, "i", "k", 9, 4000, 9), cells(spark, 4000, "k", "j", 4000, 9, 10)
    expected = {"cells": thin, "tiles": dense, "segments": flat}
    for method, (a, b) in expected.items():
        assert sm.plan_product(a, b, duplicates="unique").method == method
        for zeros in ("structural", "drop"):
            got = {tuple(r) for r in sm.auto_matmul(a, b, zeros=zeros, duplicates="unique").select("i", "j", "v").collect()}
            assert got == {tuple(r) for r in a.join(b, "k").groupBy("i", "j").count().collect()}


def test_mask_bits_are_those_of_the_wanted_cells(spark):
    wanted = cells(spark, 5000, "i", "j", 300, 300, 11).select("i", "j").cache()
    pieces = {r.piece: r.words for r in mask_bits(wanted).collect()}
    assert all(len(w) == 512 for w in pieces.values())
    places = wanted.select(F.pmod(F.xxhash64("i", "j"), F.lit(1 << 26)).alias("p")).distinct().collect()
    for (p,) in places:
        byte = (p >> 3) & 4095
        word = pieces[p >> 15][byte // 8] & (2**64 - 1)
        assert word.to_bytes(8, "big")[byte % 8] >> (p & 7) & 1
    assert sum((w & (2**64 - 1)).bit_count() for ws in pieces.values() for w in ws) == len(places)


def test_a_large_mask_is_probed_below_the_partial_sum(spark, tmp_path):
    a, b = cells(spark, 6000, "i", "k", 300, 40, 12), cells(spark, 3000, "k", "j", 40, 200, 13)
    wanted = cells(spark, 900, "i", "j", 300, 200, 14).select("i", "j")
    for name, df in (("a", a), ("b", b), ("w", wanted)):
        df.write.parquet(str(tmp_path / name))
    a, b, wanted = (spark.read.parquet(str(tmp_path / name)) for name in "abw")
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        c = sm.masked_matmul(a, b, wanted, duplicates="unique")
        lines = plan(c, "simple").splitlines()
        partial = next(n for n, line in enumerate(lines) if "partial_sum(p#" in line)
        probe = next(n for n, line in enumerate(lines) if "words#" in line and re.search("Filter|BroadcastHashJoin", line))
        assert partial < probe and not any("Exchange hashpartitioning(i#" in line for line in lines[partial:probe])
        got = {tuple(r) for r in c.collect()}
    true = a.withColumnRenamed("v", "x").join(b, "k").join(wanted, ["i", "j"]).groupBy("i", "j").count()
    assert got == {tuple(r) for r in true.collect()}
    for mask in ("list", "bitmap"):
        assert got == {tuple(r) for r in sm.masked_matmul(a, b, wanted, mask=mask).collect()}


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_lines_are_counted_by_reason_in_one_pass(spark):
    counts = sm.LineCounts()
    text = lines(spark, "1 2 3", "1 2", "", "1 x 3", "4 5 6 note", None, "1 2 3.5")
    df = sm.parse_coo(text, mode="DROPMALFORMED", counts=counts)
    assert plan(df, "simple").count("Scan") == 1
    assert len(df.collect()) == 2
    found = counts.get()
    assert found == {"lines": 7, "malformed": 5, "too_short": 3, "not_a_number": 2}
    with pytest.raises(sm.MalformedLines, match="5 of 7"):
        counts.check(max_malformed=4)
    with pytest.raises(sm.MalformedLines, match="too_short"):
        counts.check(max_share=0.5)
    assert counts.check(max_malformed=5, max_share=0.8)["lines"] == 7


@pytest.mark.parametrize(
    ("parse", "values", "expected"),
    [
        (sm.parse_row_vectors, ("1 2 3", "1", "x 2 3", "1 2", "1 2 y"), {"head": 1, "unpaired": 1, "not_a_number": 1}),
        (sm.parse_scaled_rows, ("1 2 3 4", "1", "1 2 3", "1 2 3 y"), {"head": 1, "unpaired": 1, "not_a_number": 1}),
        (sm.parse_outer_records, ("1 1 2 3 4", "x 1 2", "5 1 2", "0 1 y"), {"head": 1, "count": 1, "not_a_number": 1}),
    ],
)
def test_records_are_counted_by_reason(spark, parse, values, expected):
    counts = sm.LineCounts()
    kept = parse(lines(spark, *values), mode="PERMISSIVE", counts=counts)
    kept.collect()
    assert counts.get() == {"lines": len(values), "malformed": sum(expected.values())} | expected


def test_generated_rows_of_many_blocks(spark):
    """More blocks in a row than are numbered in one array; no place twice, density as asked for."""
    n, density = 30_000_000, 0.0024  # 4,500 blocks of 6,667 columns
    row = spark.createDataFrame([(1,)], "i bigint")
    found = sm.sample_rows(row, n, density, 3).agg(F.count("k").alias("n"), F.countDistinct("k").alias("d"), F.min("k").alias("a"), F.max("k").alias("z")).first()
    assert found.n == found.d and abs(found.n / (n * density) - 1) < 0.03
    assert 1 <= found.a and n - 50_000 < found.z <= n
    a, b = sm.sample_pair(spark.range(1, 40).toDF("x"), 50, 0.2, 4)
    assert a.columns == ["i", "k", "v"]
    assert b.columns == ["k", "j", "v"] and b.where("k > 50 OR j > 39").count() == 0 and b.count() > 200
