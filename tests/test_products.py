from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import sparsemat as sm
from helpers import QUERY_FAILURE, A_CELLS, B_CELLS, C_CELLS, matrix_a, matrix_b, product, random_pair, rows, vectors

SKEW = ("salt", "off")


def _row_cells(df):
    return rows(sm.from_row_vectors(df, "i", "j"))


STRATEGIES = {
    "matmul": lambda a, b, s: rows(sm.matmul(a, b, zeros="drop", skew=s)),
    "partials": lambda a, b, s: rows(sm.merge_partials(sm.partial_products(a, b, skew=s), zeros="drop")),
    "row": lambda a, b, s: _row_cells(
        sm.row_matmul(sm.to_row_vectors(a), sm.to_row_vectors(b, "k", "j"), skew=s)
    ),
    "row_short": lambda a, b, s: _row_cells(
        sm.row_matmul(
            sm.to_row_vectors(a, width=4), sm.to_row_vectors(b, "k", "j", width=3), width=2, skew=s
        )
    ),
    "outer": lambda a, b, s: rows(sm.outer_matmul(sm.cogroup_outer(a, b, skew=s), zeros="drop")),
    "outer_rows": lambda a, b, s: _row_cells(
        sm.outer_matmul(sm.cogroup_outer(a, b, la=5, lb=2, skew=s), zeros="drop", result="rows", width=3)
    ),
    "scaled": lambda a, b, s: rows(sm.scaled_matmul(sm.scaled_rows(a, b, width=3, skew=s), zeros="drop")),
    "segmented": lambda a, b, s: rows(sm.segmented_matmul(a, b, 4, 3, zeros="drop", skew=s)),
    "blocks": lambda a, b, s: rows(sm.block_matmul(a, b, 5, 4, 3, skew=s)),
    "tiles": lambda a, b, s: rows(sm.block_matmul(a, b, 5, 4, 3, kernel="tiles", skew=s)),
    "probes": lambda a, b, s: rows(
        sm.masked_matmul(
            a, b, a.select("i").distinct().join(b.select("j").distinct()), via="probes", zeros="drop", skew=s
        )
    ),
    "masked": lambda a, b, s: rows(
        sm.masked_matmul(a, b, a.select("i").distinct().join(b.select("j").distinct()), zeros="drop", skew=s)
    ),
}


@pytest.mark.parametrize("name", STRATEGIES)
def test_golden_product(spark, name):
    a, b = matrix_a(spark, A_CELLS), matrix_b(spark, B_CELLS)
    assert STRATEGIES[name](a, b, "auto") == C_CELLS


@pytest.mark.parametrize("skew", SKEW)
@pytest.mark.parametrize("name", STRATEGIES)
def test_strategies_agree_with_definition(spark, name, skew):
    a, b = random_pair(7)
    expected = product(a, b, "drop")
    assert any(c[2] == 0 for c in product(a, b))  # the fixture has sums that cancel
    assert STRATEGIES[name](matrix_a(spark, a), matrix_b(spark, b), skew) == expected


@pytest.mark.parametrize("skew", SKEW)
@pytest.mark.parametrize("zeros", ("structural", "drop", "dense_support"))
def test_zero_policies(spark, zeros, skew):
    a, b = random_pair(11, density=0.1, hot=False)
    ours = sm.matmul(matrix_a(spark, a), matrix_b(spark, b), zeros=zeros, skew=skew)
    assert rows(ours) == product(a, b, zeros)
    assert len(product(a, b, "drop")) < len(product(a, b)) < len(product(a, b, "dense_support"))


@pytest.mark.parametrize("zeros", ("structural", "drop"))
def test_layout_products_keep_structural_zeros(spark, zeros):
    a, b = random_pair(12, density=0.15)
    da, db = matrix_a(spark, a), matrix_b(spark, b)
    expected = product(a, b, zeros)
    assert rows(sm.outer_matmul(sm.cogroup_outer(da, db), zeros=zeros)) == expected
    assert rows(sm.scaled_matmul(sm.scaled_rows(da, db), zeros=zeros)) == expected
    assert rows(sm.segmented_matmul(da, db, 3, 3, zeros=zeros)) == expected
    by_row = sm.row_matmul(sm.to_row_vectors(da), sm.to_row_vectors(db, "k", "j"), zeros=zeros)
    assert _row_cells(by_row) == expected


def test_row_product_fixture(spark):
    a = matrix_a(spark, [(1, 1, 1), (1, 3, 1)])
    b = matrix_b(spark, [(1, 2, 1), (1, 3, 1), (2, 1, 1), (2, 2, 1), (2, 3, 1), (3, 1, 1)])
    c = sm.row_matmul(sm.to_row_vectors(a), sm.to_row_vectors(b, "k", "j"))
    assert vectors(c) == [(1, [(1, 1), (2, 1), (3, 1)])]


def test_partial_products_of_one_k(spark):
    a = matrix_a(spark, [(1, 1, 1), (2, 1, 4)])
    b = matrix_b(spark, [(1, 1, 10), (1, 2, 15)])
    assert rows(sm.partial_products(a, b)) == [(1, 1, 1, 10), (1, 1, 2, 15), (1, 2, 1, 40), (1, 2, 2, 60)]


@pytest.mark.parametrize("skew", SKEW)
def test_empty_rows(spark, skew):
    # Row 2 has no partner in B, row 3 cancels to nothing.
    a = matrix_a(spark, [(1, 1, 2), (2, 9, 5), (3, 1, 1), (3, 2, -1)])
    b = matrix_b(spark, [(1, 1, 7), (2, 1, 7)])
    ra, rb = sm.to_row_vectors(a), sm.to_row_vectors(b, "k", "j")
    assert vectors(sm.row_matmul(ra, rb, skew=skew)) == [(1, [(1, 14)])]
    kept = sm.row_matmul(ra, rb, empty_rows="keep", skew=skew)
    assert vectors(kept) == [(1, [(1, 14)]), (2, []), (3, [])]


def test_empty_row_keeps_one_record_beside_high_segments(spark):
    a = matrix_a(spark, [(1, 1, 1), (2, 2, 1)])
    b = matrix_b(spark, [(1, 100, 5)])
    ra, rb = sm.to_row_vectors(a), sm.to_row_vectors(b, "k", "j")
    kept = sm.row_matmul(ra, rb, empty_rows="keep", width=10)
    assert sorted((r.i, r.seg, len(r.vec)) for r in kept.collect()) == [(1, 9, 1), (2, 0, 0)]


def test_unordered_row_vectors_and_scattered_records(spark):
    """Entries may come in any order, and one row in several records."""
    ra = sm.parse_row_vectors(spark.createDataFrame([("1 3 3 1 1",), ("1 2 2",)], "value string"))
    rb = sm.parse_row_vectors(
        spark.createDataFrame([("1 2 15 1 10",), ("3 1 11 2 9",), ("2 2 2",)], "value string"), "k"
    )
    assert vectors(sm.row_matmul(ra, rb)) == [(1, [(1, 43), (2, 46)])]


@pytest.mark.parametrize("skew", SKEW)
def test_repeated_cells(spark, skew):
    a = [(1, 1, 2), (1, 1, 3), (1, 2, 4)]
    b = [(1, 1, 10), (2, 1, 1), (2, 1, 1)]
    da, db = matrix_a(spark, a), matrix_b(spark, b)
    assert rows(sm.matmul(da, db, skew=skew)) == [(1, 1, 58)]
    # Declared unique but not: sums are bilinear, so the result is the same.
    assert rows(sm.matmul(da, db, duplicates="unique", skew=skew)) == [(1, 1, 58)]
    assert rows(sm.matmul(da, db, duplicates="max", skew=skew)) == [(1, 1, 34)]
    with pytest.raises(QUERY_FAILURE, match="duplicate cell"):
        sm.matmul(da, db, duplicates="error", skew=skew).collect()
    for kernel in ("cells", "tiles"):
        assert rows(sm.block_matmul(da, db, 2, 2, 2, kernel=kernel, skew=skew)) == [(1, 1, 58)]


def test_repeated_entries_in_row_vectors(spark):
    ra = sm.parse_row_vectors(spark.createDataFrame([("1 1 2 1 3",)], "value string"))
    rb = sm.parse_row_vectors(spark.createDataFrame([("1 1 10 1 1",)], "value string"), "k")
    assert vectors(sm.row_matmul(ra, rb, duplicates="sum")) == [(1, [(1, 55)])]
    assert vectors(sm.row_matmul(ra, rb, duplicates="max")) == [(1, [(1, 30)])]


BIG = 2147483647


def _int32(x):
    return (x + 2**31) % 2**32 - 2**31


@pytest.mark.parametrize("kernel", ("cells", "tiles"))
def test_wrap_int32(spark, kernel):
    a = [(1, k, BIG - k) for k in range(1, 40)]
    b = [(k, 1, BIG - 2 * k) for k in range(1, 40)]
    da, db = matrix_a(spark, a), matrix_b(spark, b)
    expected = [(1, 1, _int32(sum(x[2] * y[2] for x, y in zip(a, b))))]
    assert rows(sm.matmul(da, db, wrap_int32=True)) == expected
    assert rows(sm.block_matmul(da, db, 2, 16, 2, kernel=kernel, wrap_int32=True)) == expected
    assert rows(sm.segmented_matmul(da, db, wrap_int32=True)) == expected
    assert rows(sm.scaled_matmul(sm.scaled_rows(da, db), wrap_int32=True)) == expected
    by_row = sm.row_matmul(sm.to_row_vectors(da), sm.to_row_vectors(db, "k", "j"), wrap_int32=True)
    assert _row_cells(by_row) == expected


def test_wrapped_value(spark):
    df = spark.sql(f"SELECT {BIG}L * 3 AS v UNION ALL SELECT -{BIG}L * 3")
    assert rows(df.select(sm.wrap_int32(F.col("v")))) == [(-2147483645,), (2147483645,)]


@pytest.mark.parametrize("kernel", ("cells", "tiles"))
def test_bigint_values_are_exact_and_overflow_fails(spark, kernel):
    a = matrix_a(spark, [(1, 1, 3_000_000_019), (1, 2, 1)])
    b = matrix_b(spark, [(1, 1, 3_000_000_017), (2, 1, 1)])
    expected = [(1, 1, 3_000_000_019 * 3_000_000_017 + 1)]
    assert rows(sm.matmul(a, b)) == expected
    assert rows(sm.block_matmul(a, b, 2, 2, 2, kernel=kernel)) == expected
    huge = matrix_a(spark, [(1, 1, 2**62)])
    with pytest.raises(QUERY_FAILURE, match="(?i)overflow"):
        sm.block_matmul(huge, b, 2, 2, 2, kernel=kernel).collect()
    with pytest.raises(QUERY_FAILURE, match="(?i)overflow"):
        sm.matmul(huge, b).collect()


def test_tile_kernel_beyond_double_precision(spark):
    """Sums between 2^53 and 2^63 take the integer path."""
    a = [(1, k, 2**30 + k) for k in range(1, 9)]
    b = [(k, 1, 2**29 - k) for k in range(1, 9)]
    ours = sm.block_matmul(matrix_a(spark, a), matrix_b(spark, b), 8, 8, 8, kernel="tiles")
    assert rows(ours) == product(a, b)


def test_dims_are_checked(spark):
    a, b = matrix_a(spark, A_CELLS), matrix_b(spark, B_CELLS)
    assert rows(sm.matmul(a, b, dims=(4, 3, 2))) == C_CELLS
    for dims in ((3, 3, 2), (4, 2, 2), (4, 3, 1)):
        with pytest.raises(QUERY_FAILURE, match="outside 1.."):
            sm.matmul(a, b, dims=dims).collect()
    zero_based = matrix_a(spark, [(0, 1, 1)])
    with pytest.raises(QUERY_FAILURE, match="outside 1.."):
        sm.matmul(zero_based, b, dims=(4, 3, 2)).collect()


@pytest.mark.parametrize("via", ("products", "probes"))
def test_masked_policies(spark, via):
    a = matrix_a(spark, [(1, 1, 2), (2, 1, 1), (2, 2, -1), (3, 5, 1)])
    b = matrix_b(spark, [(1, 1, 3), (2, 1, 3), (2, 2, 4)])
    pairs = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 1), (4, 1), (1, 1)], "i int, j int")
    assert rows(sm.masked_matmul(a, b, pairs, via=via)) == [(1, 1, 6), (2, 1, 0)]
    assert rows(sm.masked_matmul(a, b, pairs, via=via, zeros="drop")) == [(1, 1, 6)]
    dense = sm.masked_matmul(a, b, pairs, via=via, zeros="dense_support")
    assert rows(dense) == [(1, 1, 6), (1, 2, 0), (2, 1, 0), (3, 1, 0)]


def test_identity_transpose_and_distributivity(spark):
    a_cells, b_cells = random_pair(21)
    _, b2_cells = random_pair(22)
    a, b, b2 = matrix_a(spark, a_cells), matrix_b(spark, b_cells), matrix_b(spark, b2_cells)

    eye = spark.range(1, 18).select(F.col("id").alias("k"), F.col("id").alias("j"), F.lit(1).alias("v"))
    assert rows(sm.matmul(a, eye)) == sorted(a_cells)

    left = sm.transpose(sm.matmul(a, b), "i", "j")
    bt = b.select(F.col("j").alias("i"), "k", "v")
    at = a.select("k", F.col("i").alias("j"), "v")
    assert rows(left) == rows(sm.matmul(bt, at))

    both = sm.matmul(a, b.unionByName(b2), zeros="drop")
    summed = sm.matmul(a, b).unionByName(sm.matmul(a, b2)).groupBy("i", "j").agg(F.sum("v").alias("v"))
    assert rows(both) == rows(summed.where("v <> 0"))


@pytest.mark.parametrize("skew", SKEW)
def test_empty_factor(spark, skew):
    a, b = matrix_a(spark, []), matrix_b(spark, B_CELLS)
    for name, run in STRATEGIES.items():
        assert run(a, b, skew) == [], name


def test_unknown_options_are_rejected(spark):
    a, b = matrix_a(spark, A_CELLS), matrix_b(spark, B_CELLS)
    for options in ({"zeros": "all"}, {"duplicates": "last"}, {"skew": "maybe"}):
        with pytest.raises(ValueError, match="must be one of"):
            sm.matmul(a, b, **options)


# One case per trap that a hand-written reduce can fall into.


def test_row_without_partner_does_not_swallow_the_next(spark):
    a = matrix_a(spark, [(1, 9, 5), (2, 1, 3)])
    b = matrix_b(spark, [(1, 1, 2)])
    assert rows(sm.matmul(a, b)) == [(2, 1, 6)]


def test_missing_a_row_makes_no_result_row(spark):
    a = matrix_a(spark, [(1, 1, 1), (3, 1, 1)])
    b = matrix_b(spark, [(1, 1, 2), (2, 1, 9)])
    c = sm.row_matmul(sm.to_row_vectors(a), sm.to_row_vectors(b, "k", "j"), empty_rows="keep")
    assert vectors(c) == [(1, [(1, 2)]), (3, [(1, 2)])]


def test_a_column_without_b_row_does_not_meet_the_next_k(spark):
    a = matrix_a(spark, [(1, 1, 5)])
    b = matrix_b(spark, [(2, 1, 7)])
    assert rows(sm.segment_pairs(a, b, 1, 1)) == []
    assert rows(sm.segmented_matmul(a, b, 1, 1)) == []


def test_scaling_does_not_compound(spark):
    a = matrix_a(spark, [(1, 1, 2), (2, 1, 3), (3, 1, 5)])
    b = matrix_b(spark, [(1, 1, 7)])
    c = sm.outer_matmul(sm.cogroup_outer(a, b), result="rows", zeros="drop")
    assert vectors(c) == [(1, [(1, 14)]), (2, [(1, 21)]), (3, [(1, 35)])]


def test_more_rows_than_columns(spark):
    a = [(i, 1, i) for i in range(1, 30)]
    b = [(1, 1, 1), (1, 2, 2)]
    c = sm.row_matmul(
        sm.to_row_vectors(matrix_a(spark, a)), sm.to_row_vectors(matrix_b(spark, b), "k", "j"), empty_rows="keep"
    )
    assert _row_cells(c) == product(a, b)
