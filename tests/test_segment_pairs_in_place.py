"""Pairs of segments repeat both of their segments, so they are multiplied where they are joined."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from test_plans import SF_DIR, _above_join, setting


@pytest.mark.parametrize("limit", ["-1", "10MB"])
@pytest.mark.parametrize("name", ["segmented_hot_key_ranges", "segmented_matmul", "segmented_matmul_summed"])
def test_sums_alone_are_shuffled_above_the_join(spark, name, limit):
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", limit):
        above = _above_join(contract.queries()[name](spark, SF_DIR))
    exchanges = [n for n, line in enumerate(above) if "Exchange" in line]
    assert len(exchanges) == 1 and "hashpartitioning(i#" in above[exchanges[0]]
    assert any("HashAggregate" in line and "partial_sum(p#" in line for line in above[exchanges[0] :])
