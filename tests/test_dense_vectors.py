"""Dense vectors that are nearly all zeros."""

from __future__ import annotations

from pyspark.sql import functions as F

import sparsemat as sm


def test_entries_are_made_for_non_zeros_alone(spark):
    """Beside the last index there is no next one, and none is asked for."""
    last = 2**63 - 1
    (found,) = spark.range(1).select(sm.vec_from_dense(F.expr("array(5L, 0L, 0L)"), last - 1).alias("vec")).collect()
    assert [tuple(e) for e in found.vec] == [(last, 5)]


def test_dense_and_back_over_neighbours_gaps_and_both_ends(spark):
    wanted = [(65537, 3), (65538, -1), (65539, 0), (70000, 7), (131072, 2)]
    vec = F.array(*(F.struct(F.lit(x).cast("bigint").alias("x"), F.lit(v).cast("bigint").alias("v")) for x, v in reversed(wanted)))
    dense = spark.range(1).select(sm.vec_to_dense(vec, 65536, 65536).alias("d"))
    (d,) = dense.first()
    assert len(d) == 65536 and {n: v for n, v in enumerate(d) if v} == {x - 65537: v for x, v in wanted if v}
    (back,) = dense.select(sm.vec_from_dense("d", 65536)).first()
    assert [tuple(e) for e in back] == [(x, v) for x, v in wanted if v]
