"""Long lists of wanted cells with zeros where the product has none."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import sparsemat as sm
from helpers import matrix_a, matrix_b, product, rows
from test_plans import SF_DIR, made_per_task, plan, setting


@pytest.mark.parametrize("limit", ["-1", "10MB"])
@pytest.mark.parametrize("step", [1, 3, 1000])
def test_listed_cells_of_several_ranges(spark, limit, step):
    """Ranges with most of their columns and with few; copies in the list, and cells of no row or column."""
    rng = random.Random(5)
    a = [(i, k, rng.randint(-3, 3)) for i in range(1, 8) for k in range(1, 6) if rng.random() < 0.6]
    b = [(rng.randint(1, 5), j, rng.randint(-3, 3)) for j in range(1, 70_000, step)]
    listed = [(rng.randint(0, 9), rng.choice([-70_000, -1, 0, 1, 32_768, 32_769, 65_536, 65_537, rng.randint(1, 70_100)])) for _ in range(500)]
    listed += [(i, j) for i, j, _ in rng.sample(product(a, b), 50)] * 2
    pairs = spark.createDataFrame(listed, "i bigint, j bigint")
    a_frame, b_frame = matrix_a(spark, a), matrix_b(spark, b)
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", limit):
        found = rows(sm.masked_matmul(a_frame, b_frame, pairs, zeros="dense_support", duplicates="unique"))
    wanted = set(listed)
    assert found == [c for c in product(a, b, "dense_support") if c[:2] in wanted]


def test_a_long_list_is_shuffled_as_sets(spark):
    """No exchange has a row for each listed cell, and few files are work for many tasks."""
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        query = contract.queries()["masked_matmul_dense"](spark, SF_DIR)
        text = plan(query, "simple")
    lines = [line for line in text.splitlines() if "Aggregate" in line]
    assert any("partial_collect_set" in line for line in lines)
    # cells i, j are grouped for the sums of products alone
    assert all("sum(p#" in line for line in lines if "keys=[i#" in line and ", j#" in line and "functions=[]" in line)
    assert len(made_per_task(query.select(F.col("i")))) > 1
