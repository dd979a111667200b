from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import sparsemat as sm
from helpers import QUERY_FAILURE


def _frame(spark, *columns):
    names = ("u", "w")[: len(columns)]
    schema = ", ".join(f"{n} array<struct<x: bigint, v: bigint>>" for n in names)
    return spark.createDataFrame([columns], schema)


def _one(df, column):
    value = df.select(column.alias("r")).first().r
    return [tuple(e) for e in value] if isinstance(value, list) and value and isinstance(value[0], tuple) else value


def test_scale_and_drop_zeros(spark):
    df = _frame(spark, [(1, 2), (4, 0)])
    assert _one(df, sm.vec_scale("u", 3)) == [(1, 6), (4, 0)]
    assert _one(df, sm.vec_scale("u", F.lit(-1))) == [(1, -2), (4, 0)]
    assert _one(df, sm.vec_drop_zeros("u")) == [(1, 2)]
    assert _one(df, sm.vec_nnz("u")) == 2


@pytest.mark.parametrize(
    "vec, dense",
    [
        ([], [0, 0, 0, 0]),
        ([(1, 5)], [5, 0, 0, 0]),
        ([(4, 5)], [0, 0, 0, 5]),
        ([(2, 7), (3, -1)], [0, 7, -1, 0]),
        ([(3, -1), (2, 7)], [0, 7, -1, 0]),
        ([(1, 1), (2, 2), (3, 3), (4, 4)], [1, 2, 3, 4]),
    ],
)
def test_dense_and_back(spark, vec, dense):
    df = _frame(spark, vec)
    assert _one(df, sm.vec_to_dense("u", 4)) == dense
    back = df.select(sm.vec_to_dense("u", 4).alias("d")).select(sm.vec_from_dense("d").alias("r")).first().r
    assert [tuple(e) for e in back] == sorted(vec)


def test_dense_with_offset(spark):
    df = _frame(spark, [(11, 5), (13, 6)])
    assert _one(df, sm.vec_to_dense("u", 4, 10)) == [5, 0, 6, 0]
    assert _one(df, sm.vec_from_dense(sm.vec_to_dense("u", 4, 10), 10)) == [(11, 5), (13, 6)]


@pytest.mark.parametrize("bad", [[(5, 1)], [(0, 1)], [(1, 1), (9, 1)]])
def test_dense_rejects_indices_outside(spark, bad):
    with pytest.raises(QUERY_FAILURE, match="outside the dense range"):
        _frame(spark, bad).select(sm.vec_to_dense("u", 4)).collect()


def test_dot(spark):
    df = _frame(spark, [(1, 2), (3, 4), (9, 5)], [(3, 10), (9, -1), (11, 100)])
    assert _one(df, sm.sparse_dot("u", "w")) == 35
    assert _one(_frame(spark, [(1, 2)], [(2, 3)]), sm.sparse_dot("u", "w")) == 0
    assert _one(_frame(spark, [], []), sm.sparse_dot("u", "w")) == 0


def test_dot_rejects_repeated_index(spark):
    with pytest.raises(QUERY_FAILURE, match="(?i)duplicate"):
        _frame(spark, [(1, 2), (1, 3)], [(1, 1)]).select(sm.sparse_dot("u", "w")).collect()


def test_axpy(spark):
    df = _frame(spark, [(1, 2), (3, 4)], [(2, 5), (3, -8), (4, 1)])
    assert _one(df, sm.vec_axpy(2, "u", "w")) == [(1, 4), (2, 5), (4, 1)]


def test_text(spark):
    assert _one(_frame(spark, [(1, 2), (3, -4)]), sm.vec_text("u")) == "1 2 3 -4 "
    assert _one(_frame(spark, []), sm.vec_text("u")) == ""
