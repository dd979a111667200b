"""A factor made by unfolding rows is larger than Catalyst's estimate of it."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import sparsemat as sm
from sparsemat.operators.skew import fits_broadcast, planned_bytes
from test_plans import made_per_task, plan, setting
from test_sizes import cells
from test_stored import as_dict, product


@pytest.mark.parametrize("skew", ["auto", "salt", "off"])
@pytest.mark.parametrize("limit, adaptive", [("100KB", "true"), ("20KB", "true"), ("20KB", "false")])
def test_a_generated_factor_is_not_broadcast_by_its_estimate(spark, skew, limit, adaptive):
    b = sm.sample_rows(spark.range(1, 201, 1, 1).toDF("k"), 1000, 0.5, 3, col="j")
    a = cells(spark, 3000, "i", "k", 400, 200, 61)
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", limit), setting(spark, "spark.sql.adaptive.enabled", adaptive):
        assert planned_bytes(b) < 20 << 10 and b.count() > 90_000 and not fits_broadcast(b)
        c = sm.matmul(a, b, duplicates="unique", skew=skew)
        inner = re.findall(r"BroadcastHashJoin.*Inner, Build(\w+)", plan(c, "simple"))
        assert "Right" not in inner
        assert as_dict(c) == product(a, b)


def test_rows_of_one_file_are_generated_by_many_tasks(spark):
    made = made_per_task(sm.sample_rows(spark.range(1, 401, 1, 1).toDF("i"), 500, 0.2, 5))
    assert len(made) == int(spark.conf.get("spark.sql.shuffle.partitions")) and made[0] < 3 * sum(made) / len(made)
