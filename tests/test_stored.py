"""Stored factors, products brought up to date, and tiles on a grid."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

import sparsemat as sm
from sparsemat.operators.tiles import deal_to_grid
from test_plans import plan, setting
from test_sizes import cells


def product(a, b):
    joined = a.withColumnRenamed("v", "x").join(b, "k").groupBy("i", "j").agg(F.sum(F.col("x") * F.col("v")).alias("v"))
    return {(r.i, r.j): r.v for r in joined.collect() if r.v}


def as_dict(c):
    return {(r.i, r.j): r.v for r in c.collect() if r.v}


def test_stored_factors_are_joined_as_they_lie(spark, tmp_path):
    """Half of A's cells are on k = 1, which is stored in several buckets."""
    a = cells(spark, 4000, "i", "k", 2000, 50, 21).withColumn("v", F.col("i") % 7 - 3)
    a = a.withColumn("k", F.when(F.col("i") % 2 == 0, 1).otherwise(F.col("k"))).groupBy("i", "k").agg(F.sum("v").alias("v"))
    b = cells(spark, 800, "k", "j", 60, 40, 22).withColumn("v", F.col("j") % 5 - 2)
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        sm.store_factors(a, b, "kept", str(tmp_path / "kept"), 8, duplicates="unique")
        c = sm.stored_matmul(spark, "kept")
        text = plan(c, "simple")
        assert "SortMergeJoin" in text and "Exchange" not in text[text.index("SortMergeJoin") :]
        assert as_dict(c) == product(a, b)
    hot = spark.table("kept_a").where("k = 1").select(F.input_file_name().alias("f"), "_ls").distinct().collect()
    assert len({r.f for r in hot}) > 3 and len({r._ls for r in hot}) > 3
    for side in "ab":
        files = [f for f in os.listdir(tmp_path / "kept" / side) if f.startswith("part-")]
        assert len(files) <= 8  # one file per bucket
        spark.sql(f"DROP TABLE kept_{side}")


def test_three_changes_rewrite_the_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "store")
    a = cells(spark, 900, "i", "k", 60, 64, 31)
    b = cells(spark, 900, "k", "j", 64, 60, 32)
    sm.write_partials(sm.partial_products(a, b), path, 16)

    def files():
        return {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part-")}

    def cell_frame(names, *rows):
        return spark.createDataFrame(list(rows), f"{names[0]} long, {names[1]} long, v long")

    none_a, none_b = a.limit(0), b.limit(0)
    removed = a.where("k = 20").withColumn("v", -F.col("v"))
    changes = [
        (cell_frame("ik", (1, 3, 5), (2, 3, 1), (1, 3, 2)), none_b),
        (cell_frame("ik", (7, 5, -4)), cell_frame("kj", (5, 9, 10), (21, 1, 3))),
        (removed, cell_frame("kj", (20, 2, 8))),
    ]
    for (da, db), expected in zip(changes, ([3], [5], [4]), strict=True):
        before = files()
        numbers = sm.update_partials(spark, path, 16, a, b, da, db)
        assert numbers == expected
        after = files()
        folder = {n: {f for f in os.listdir(f"{path}/k_bucket={n}") if f.startswith("part-")} for n in range(16)}
        for n in range(16):
            if n not in numbers:
                assert all(after[f] == before[f] for f in folder[n])
        a = a.unionByName(da).groupBy("i", "k").agg(F.sum("v").alias("v"))
        b = b.unionByName(db).groupBy("k", "j").agg(F.sum("v").alias("v"))
        assert as_dict(sm.merge_partials(sm.read_partials(spark, path))) == product(a, b)
    before = files()
    assert sm.update_partials(spark, path, 16, a, b, none_a, none_b) == [] and files() == before


@pytest.mark.parametrize("grid", [(1, 1, 1), (3, 2, 2), (1, 4, 1), (2, 1, 5)])
def test_grid_product(spark, grid):
    a = cells(spark, 3000, "i", "k", 70, 90, 41).withColumn("v", F.col("i") % 7 - 3)
    b = cells(spark, 3000, "k", "j", 90, 50, 42).withColumn("v", F.col("j") % 5 - 2)
    a = a.unionByName(spark.range(1, 71).select(F.col("id").alias("i"), F.lit(200).alias("k"), F.lit(1).alias("v")))
    b = b.unionByName(spark.range(1, 51).select(F.lit(200).alias("k"), F.col("id").alias("j"), F.lit(2).alias("v")))
    assert as_dict(sm.grid_matmul(a, b, 16, 16, 8, grid)) == product(a, b)


def test_tiles_travel_once_per_row_or_column_of_the_grid(spark, tmp_path):
    """The records that are shuffled are tiles(A) * columns + tiles(B) * rows, and pairs stay in place."""
    cells(spark, 5000, "i", "k", 128, 128, 43).write.parquet(str(tmp_path / "a"))
    cells(spark, 5000, "k", "j", 128, 128, 44).write.parquet(str(tmp_path / "b"))
    a, b = (spark.read.parquet(str(tmp_path / n)) for n in "ab")
    left, right = sm.to_tiles(a, "i", "k", 8, 8), sm.to_tiles(b, "k", "j", 8, 8, ("kb", "jb"))
    grid = (3, 2, 2)
    dealt = deal_to_grid(left, right, grid)
    assert dealt[0].count() == 2 * left.count() and dealt[1].count() == 3 * right.count()
    per = dealt[0].groupBy("_task").count().collect()
    assert len(per) == 12 and max(r["count"] for r in per) <= 3 * sum(r["count"] for r in per) / 12
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        lines = plan(sm.grid_matmul(a, b, 8, 8, 8, grid, duplicates="unique"), "simple").splitlines()
    kernel = next(n for n, line in enumerate(lines) if "MapInArrow" in line)
    join = next(n for n, line in enumerate(lines) if "Join" in line)
    assert not any("Exchange" in line for line in lines[kernel:join])
    assert sum(bool(re.search("shufflepartitionidpassthrough", line)) for line in lines) == 2


def test_grids_that_move_the_least():
    # the two other directions stay at 1; 12 of 16 tasks are enough
    for one, sizes in ((1, (1, 1000, 100)), (0, (1000, 1, 100)), (2, (100, 100, 1))):
        grid = sm.choose_grid(16, *sizes)
        assert 12 <= grid[one] <= 16 and sum(grid) == grid[one] + 2
    rows, columns, slices = sm.choose_grid(16, 100, 100, 10_000)
    assert slices == 1 and rows * columns >= 12 and max(rows, columns) <= 4
    assert sm.choose_grid(1, 1, 1, 1) == (1, 1, 1)
    with pytest.raises(ValueError, match="grid"):
        sm.grid_matmul(None, None, 1, 1, 1, (0, 1, 1))
