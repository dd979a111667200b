"""What the plans must look like for the data to grow: checked on explain output."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import sparsemat as sm
from helpers import matrix_a, matrix_b, rows
from sparsemat import plans
from sparsemat.operators.multiply import _cut
from sparsemat.operators.skew import SLICES_PER_TASK, fits_broadcast, hot_keys, one_cell, skew_join
from sparsemat.plans.scratch import scratch_path

SF_DIR = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@contextlib.contextmanager
def setting(spark, key, value):
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


@pytest.fixture
def stored(spark, tmp_path):
    a = spark.range(2000).select(
        (F.col("id") % 200 + 1).alias("i"), (F.col("id") % 37 + 1).alias("k"), F.col("id").alias("v")
    )
    b = spark.range(300).select(
        (F.col("id") % 37 + 1).alias("k"), (F.col("id") % 50 + 1).alias("j"), F.col("id").alias("v")
    )
    a.write.parquet(str(tmp_path / "a"))
    b.write.parquet(str(tmp_path / "b"))
    return spark.read.parquet(str(tmp_path / "a")), spark.read.parquet(str(tmp_path / "b"))


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_no_query_pairs_rows_without_a_key(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_products_are_summed_before_the_shuffle(spark, stored):
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        text = plan(sm.matmul(*stored, duplicates="unique", skew="off"), "simple")
    assert re.search(r"Exchange hashpartitioning\(i#\d+L, j#\d+L.*\n.*partial_sum", text)


def test_filters_and_columns_reach_the_scans(spark, stored):
    a, b = stored
    for skew in ("off", "salt"):
        c = sm.matmul(a.withColumn("note", F.lit("x")), b, skew=skew).where("i = 3 AND j = 4")
        text = plan(c)
        assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(i,3\)", text)
        assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(j,4\)", text)
        assert "ReadSchema: struct<i:bigint,k:bigint,v:bigint>" in text


def test_small_side_is_left_to_broadcast(spark, stored):
    a, b = stored
    assert fits_broadcast(b)
    text = plan(sm.matmul(a, b, duplicates="unique"), "simple")
    assert "BroadcastHashJoin" in text and "_ls" not in text
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "100"):
        assert not fits_broadcast(b)
        assert "_ls" in plan(sm.matmul(a, b, duplicates="unique"), "simple")
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        assert not fits_broadcast(b)


def test_hot_key_is_spread_over_tasks(spark):
    """One k with a third of A and of B: no slice gets more than a fraction of the pairs."""
    a = spark.range(3000).select(
        (F.col("id") + 1).alias("i"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") + 2).alias("k"),
        F.lit(1).alias("v"),
    )
    b = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") + 2).alias("k"),
        (F.col("id") + 1).alias("j"),
        F.lit(1).alias("v"),
    )
    left, right = a.withColumnRenamed("v", "av"), b.withColumnRenamed("v", "bv")
    (hot,) = hot_keys(left, right, ["k"], one_cell("av"), one_cell("bv")).collect()
    assert (hot.k, hot._both) == (1, True)
    slices = SLICES_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert slices // 2 <= hot._nl * hot._nr <= 2 * slices
    salted = sm.matmul(a, b, duplicates="unique", skew="salt")
    assert rows(salted) == rows(sm.matmul(a, b, duplicates="unique", skew="off"))


def made_per_task(df):
    """Rows that each task of the last stage before `df` makes, the largest first."""
    counts = df.groupBy(F.spark_partition_id().alias("task")).count().collect()
    return sorted((r["count"] for r in counts), reverse=True)


def test_slices_stay_apart_when_partitions_may_be_merged(spark):
    """All products of a single k are made by tasks with about even shares."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    a = spark.range(4000).select((F.col("id") + 1).alias("i"), F.lit(1).alias("k"), F.col("id").alias("v"))
    b = spark.range(1000).select(F.lit(1).alias("k"), (F.col("id") + 1).alias("j"), F.col("id").alias("v"))
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    made = made_per_task(sm.partial_products(a, b, duplicates="unique", skew="salt"))
    assert sum(made) == 4_000_000
    assert made[0] <= 3 * sum(made) / tasks


def test_dense_fill_is_spread_when_partitions_may_be_merged(spark):
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    a = spark.range(1500).select((F.col("id") + 1).alias("i"), (F.col("id") + 1).alias("k"), F.lit(1).alias("v"))
    b = spark.range(2000).select((F.col("id") % 50 + 1).alias("k"), (F.col("id") + 1).alias("j"), F.lit(1).alias("v"))
    made = made_per_task(sm.matmul(a, b, zeros="dense_support", duplicates="unique"))
    assert sum(made) == 3_000_000
    assert made[0] <= 3 * sum(made) / tasks


def test_long_records_are_cut_and_spread(spark):
    """One line with a whole column and a whole row: several tasks unfold it."""
    long = ("transform(sequence(1L, {}L), x -> named_struct('x', x, 'v', 1L)) AS {}".format(n, c) for n, c in ((20000, "av"), (5000, "bv")))
    record = spark.range(1).selectExpr(*long)
    cut = _cut(record, "av", "bv")
    made = cut.select((F.size("av").cast("long") * F.size("bv")).alias("n"), F.spark_partition_id().alias("task"))
    loads = sorted(r["n"] for r in made.groupBy("task").agg(F.sum("n").alias("n")).collect())
    assert sum(loads) == 20000 * 5000
    assert loads[-1] <= 3 * sum(loads) / int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_pairs_are_gathered_without_a_sample(spark, stored):
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        assert "rangepartitioning" not in plan(sm.segmented_matmul(*stored, 16, 8, duplicates="unique"), "simple")
        assert "rangepartitioning" not in plan(sm.block_matmul(*stored, 16, 8, 4, duplicates="unique"), "simple")


def test_kept_rows_take_one_product(spark, stored):
    a, b = (sm.to_row_vectors(m, *n, duplicates="unique") for m, n in zip(stored, (("i", "k"), ("k", "j"))))
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        count = [plan(sm.row_matmul(a, b, empty_rows=e, skew="off"), "simple").count("Join") for e in ("drop", "keep")]
    assert count[1] == count[0] + 1


def test_lines_are_split_once(spark):
    lines = spark.range(10).select(F.concat_ws(" ", "id", "id", "id").alias("value"))
    for mode in ("FAILFAST", "PERMISSIVE", "DROPMALFORMED"):
        assert plan(sm.parse_coo(lines, mode=mode), "simple").count("split(") == 1


def test_number_of_hot_keys_is_bounded(spark):
    """Whatever the keys hold, fewer than slices-many can pass the share."""
    slices = SLICES_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
    for rows_per_key in (1, 50):
        keys = slices + 5 if rows_per_key == 50 else slices - 2
        side = spark.range(keys * rows_per_key).select((F.col("id") % keys).alias("k"), F.lit(1).alias("v"))
        left, right = side.withColumnRenamed("v", "av"), side.withColumnRenamed("v", "bv")
        found = hot_keys(left, right, ["k"], one_cell("av"), one_cell("bv")).count()
        assert found <= slices
        assert found == (0 if rows_per_key == 50 else keys)


def test_slices_do_not_depend_on_partitioning(spark):
    a = [(i, 1, i) for i in range(1, 200)]
    b = [(1, j, j) for j in range(1, 50)]
    da, db = matrix_a(spark, a), matrix_b(spark, b)
    once = rows(sm.partial_products(da.repartition(3), db.repartition(5), skew="salt"))
    again = rows(sm.partial_products(da.repartition(7), db.repartition(1), skew="salt"))
    assert once == again and len(once) == len(a) * len(b)


def test_counting_pass_shares_the_factors_exchange(spark):
    """A factor that is an aggregate is computed once, not once more for counting."""
    run = contract.queries()["matmul_hot_key"](spark, SF_DIR)
    run.collect()
    assert plan(run, "simple").split("Initial Plan")[0].count("FileScan") <= 2


def test_scratch_path_needs_a_shared_folder(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns == ["i", "j", "v"]
    assert contract.entry(spark).count() == 70


def _above_join(df) -> list[str]:
    """The lines of the plan above its topmost join of both factors."""
    lines = plan(df, "simple").splitlines()
    joins = [n for n, line in enumerate(lines) if re.search(r"(SortMerge|Hash)Join", line)]
    return lines[: joins[0]]


@pytest.mark.parametrize("limit", ["-1", "10MB"])
@pytest.mark.parametrize("name", ["outer_matmul_rows", "row_matmul_drop", "scaled_matmul_rows"])
def test_vector_sums_take_one_exchange_above_the_join(spark, name, limit):
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", limit):
        above = _above_join(contract.queries()[name](spark, SF_DIR))
    exchanges = [line for line in above if "Exchange" in line]
    assert len(exchanges) == 1 and "hashpartitioning(i#" in exchanges[0] and "seg#" in exchanges[0]
    below = above[above.index(exchanges[0]) :]
    assert any("HashAggregate" in line and "sum(p#" in line for line in below)  # summed before it travels


def test_a_hot_row_of_a_vector_sum_is_split(spark):
    """Half of all products are in row 1; they are summed by range of columns, in several tasks."""
    products = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 999 + 2).cast("bigint").alias("i"),
        (F.col("id") * 7 % 4096 + 1).alias("j"),
        F.lit(1).cast("bigint").alias("p"),
    )
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        found = sm.vector_sum(products, width=64).withColumn("task", F.spark_partition_id())
        hot = found.where("i = 1").select("task", F.size("vec").alias("n")).collect()
    assert len({r.task for r in hot}) > 4 and max(r.n for r in hot) <= 64
    expected = {(r.i, r.j): r.v for r in products.groupBy("i", "j").agg(F.sum("p").alias("v")).collect()}
    got = {(r.i, r.x): r.v for r in sm.vector_sum(products, width=64).select("i", F.inline("vec")).collect()}
    assert got == expected


@pytest.mark.parametrize("skew", ["auto", "salt", "off"])
@pytest.mark.parametrize("limit", ["-1", "10MB"])
def test_the_task_column_is_the_task(spark, stored, skew, limit):
    a, b = stored
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", limit), setting(spark, "spark.sql.adaptive.enabled", "false"):
        joined = skew_join(
            a.withColumnRenamed("v", "av"), b.withColumnRenamed("v", "bv"), ["k"],
            left_cells=one_cell("av"), right_cells=one_cell("bv"), left_split=["i"], right_split=["j"], skew=skew, task="t",
        )
        rows = joined.select("t", F.spark_partition_id().alias("p")).collect()
        assert joined.count() == a.join(b, "k").count()
        assert {r.t for r in rows} == {r.p for r in rows if r.t == r.p}
        summed = plan(joined.groupBy("t", "i").count(), "simple")
    assert summed[: summed.index("Join")].count("Exchange") == 0


def test_segments_by_degree_share_a_hot_key(spark):
    """Half of all cells are on k = 1: its pairs are dealt out, short columns stay whole."""
    a = spark.range(60_000).select(
        (F.col("id") + 1).alias("i"), F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 5000 + 2).alias("k"), F.lit(1).alias("v")
    )
    b = spark.range(5_000).select((F.col("id") + 1).alias("k"), (F.col("id") % 9 + 1).alias("j"), F.lit(1).alias("v")).unionByName(
        spark.range(90).select(F.lit(1).alias("k"), (F.col("id") + 10).alias("j"), F.lit(1).alias("v"))
    )
    pairs = sm.segment_pairs(a, b, 128, 16, duplicates="unique", by="degree", task="t")
    work = F.sum(F.size("av") * F.size("bv")).alias("work")
    loads = [r.work for r in pairs.groupBy("t").agg(work).collect()]
    assert max(loads) <= 3 * sum(loads) / len(loads) and len(loads) == 8
    assert sum(loads) == a.join(b, "k").count()
    per = {r.k: (r["count"], r.n) for r in pairs.groupBy("k").agg(F.count("*").alias("count"), F.max(F.size("av")).alias("n")).collect()}
    assert all(count == 1 for k, (count, _) in per.items() if k != 1)
    assert per[1][0] >= 6 * 200 and per[1][1] < 2 * 128
