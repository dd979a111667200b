from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import sparsemat as sm
from helpers import QUERY_FAILURE, A_CELLS, B_CELLS, matrix_a, matrix_b, random_pair, rows, vectors


def _records(df):
    return sorted((r.k, r.sa, r.sb, r.n, [tuple(e) for e in r.av], [tuple(e) for e in r.bv]) for r in df.collect())


def test_row_and_column_vectors(spark):
    a = matrix_a(spark, A_CELLS)
    assert vectors(sm.to_row_vectors(a))[:2] == [(1, [(1, 1), (2, 2), (3, 3)]), (2, [(1, 4), (2, 5)])]
    assert vectors(sm.to_column_vectors(a))[2] == (3, [(1, 3), (3, 9), (4, 12)])
    assert rows(sm.from_row_vectors(sm.to_row_vectors(a))) == A_CELLS


def test_row_vectors_are_cut_by_index_range(spark):
    a = matrix_a(spark, [(1, k, k) for k in range(1, 11)] + [(2, 9, 1)])
    cut = sm.to_row_vectors(a, width=4)
    assert sorted((r.i, r.seg, [e.x for e in r.vec]) for r in cut.collect()) == [
        (1, 0, [1, 2, 3, 4]),
        (1, 1, [5, 6, 7, 8]),
        (1, 2, [9, 10]),
        (2, 2, [9]),
    ]


def test_row_vector_duplicate_policies(spark):
    a = matrix_a(spark, [(1, 1, 2), (1, 1, 5), (1, 2, 1)])
    assert vectors(sm.to_row_vectors(a)) == [(1, [(1, 7), (2, 1)])]
    assert vectors(sm.to_row_vectors(a, duplicates="max")) == [(1, [(1, 5), (2, 1)])]
    with pytest.raises(QUERY_FAILURE, match="duplicate cell"):
        sm.to_row_vectors(a, duplicates="error").collect()


@pytest.mark.parametrize("skew", ("salt", "off"))
def test_outer_cogroup_keeps_one_sided_ks(spark, skew):
    a = matrix_a(spark, [(1, 1, 2), (4, 1, 3), (2, 2, 5)])
    b = matrix_b(spark, [(1, 7, 1), (3, 1, 9)])
    assert _records(sm.cogroup_outer(a, b, skew=skew)) == [
        (1, 0, 0, 2, [(1, 2), (4, 3)], [(7, 1)]),
        (2, 0, 0, 1, [(2, 5)], []),
        (3, 0, 0, 0, [], [(1, 9)]),
    ]


@pytest.mark.parametrize("skew", ("salt", "off"))
def test_outer_cogroup_of_one_hot_k(spark, skew):
    """One k with everything: each pair of segments exactly once, no stray halves."""
    a = matrix_a(spark, [(i, 1, i) for i in range(1, 101)] + [(1, 2, 1)])
    b = matrix_b(spark, [(1, j, j) for j in range(1, 51)] + [(3, 1, 1)])
    found = [r[:4] for r in _records(sm.cogroup_outer(a, b, la=7, lb=9, skew=skew))]
    sizes = [7] * 14 + [2]
    expected = [(1, sa, sb, sizes[sa]) for sa in range(15) for sb in range(6)]
    assert found == sorted([*expected, (2, 0, 0, 1), (3, 0, 0, 0)])


def test_segment_pairs_fixture(spark):
    pairs = sm.segment_pairs(matrix_a(spark, A_CELLS), matrix_b(spark, B_CELLS), 2, 1)
    assert len(_records(pairs)) == 10
    assert _records(pairs)[0] == (1, 0, 0, 2, [(1, 1), (2, 4)], [(1, 10)])


def test_empty_segments_make_no_pair(spark):
    a = matrix_a(spark, [(1, 1, 1), (9, 1, 2)])
    b = matrix_b(spark, [(1, 1, 3)])
    assert [r[1] for r in _records(sm.segment_pairs(a, b, 2, 2))] == [0, 4]


@pytest.mark.parametrize("skew", ("salt", "off"))
def test_scaled_rows_keep_cells_without_b_row(spark, skew):
    a = matrix_a(spark, [(i, 1, 2) for i in range(1, 31)] + [(1, 2, 5)])
    b = matrix_b(spark, [(1, 7, 1), (1, 8, 2), (3, 1, 9)])
    found = sorted(
        (r.i, r.k, r.p, [tuple(e) for e in r.bv]) for r in sm.scaled_rows(a, b, skew=skew).collect()
    )
    expected = [(i, 1, 2, [(7, 1), (8, 2)]) for i in range(1, 31)] + [(1, 2, 5, [])]
    assert found == sorted(expected)


@pytest.mark.parametrize("skew", ("salt", "off"))
def test_scaled_rows_of_hot_b_row(spark, skew):
    """A B row cut in many segments reaches every A cell whole."""
    a = matrix_a(spark, [(i, 1, i) for i in range(1, 6)])
    b = matrix_b(spark, [(1, j, j) for j in range(1, 101)])
    scaled = sm.scaled_rows(a, b, width=3, skew=skew)
    cells = scaled.select("i", "p", F.inline("bv"))
    assert rows(cells) == [(i, i, j, j) for i in range(1, 6) for j in range(1, 101)]


def test_split_halves(spark):
    df = spark.createDataFrame([(k,) for k in range(1, 6)], "k bigint")
    assert rows(sm.split_halves(df, 5)) == [(1, "A"), (2, "A"), (3, "B"), (4, "B"), (5, "B")]


@pytest.mark.parametrize("size", [(1, 1), (2, 3), (4, 2), (100, 100)])
def test_blocks_round_trip(spark, size):
    cells, _ = random_pair(3)
    a = matrix_a(spark, cells)
    tiles = sm.to_blocks(a, "i", "k", *size)
    assert rows(sm.from_blocks(tiles, "i", "k", *size)) == sorted(cells)
    assert tiles.where((F.col("il") >= size[0]) | (F.col("kl") >= size[1])).count() == 0


def test_block_address(spark):
    tiles = sm.to_blocks(matrix_a(spark, [(1, 1, 5), (5, 7, 6)]), "i", "k", 2, 3)
    assert rows(tiles) == [(0, 0, 0, 0, 5), (2, 2, 0, 0, 6)]


def test_tiles_hold_row_major_places(spark):
    tiles = sm.to_tiles(matrix_a(spark, [(1, 2, 5), (2, 1, 6), (3, 3, 7)]), "i", "k", 2, 2)
    found = sorted((r.ib, r.kb, sorted(tuple(e) for e in r.tile)) for r in tiles.collect())
    assert found == [(0, 0, [(1, 5), (2, 6)]), (1, 1, [(0, 7)])]


def test_replicate_fixture(spark):
    a = matrix_a(spark, [(1, 2, 2)])
    assert rows(sm.replicate(a, 2, "j").select("i", "j", "k", "v")) == [(1, 1, 2, 2), (1, 2, 2, 2)]
    b = matrix_b(spark, [(1, 2, 15)])
    assert rows(sm.replicate(b, 4, "i").select("i", "j", "k", "v")) == [(i, 2, 1, 15) for i in range(1, 5)]


@pytest.mark.parametrize("n", [0, 1, 4095, 4096, 4097, 10000])
def test_replicate_in_chunks(spark, n):
    df = sm.replicate(matrix_a(spark, [(1, 1, 1)]), n, "j")
    assert [r.j for r in df.orderBy("j").collect()] == list(range(1, n + 1))


def test_key_by_shared_index(spark):
    a = matrix_a(spark, [(1, 1, 1), (1, 3, 3), (2, 1, 4), (2, 2, 5)])
    b = matrix_b(spark, [(1, 2, 15)])
    assert rows(sm.tag_union(a, b)) == [(1, 0, 1, 1), (1, 0, 2, 4), (1, 1, 2, 15), (2, 0, 2, 5), (3, 0, 1, 3)]


def test_transpose_and_nnz(spark):
    a = matrix_a(spark, A_CELLS)
    assert rows(sm.transpose(a)) == sorted((k, i, v) for i, k, v in A_CELLS)
    assert rows(sm.nnz(a)) == [(11,)]


def test_sorted_by_gives_a_total_order(spark):
    cells = [(1, k, k % 5) for k in range(200, 0, -1)] + [(i, 1, 0) for i in range(50, 1, -1)]
    found = [tuple(r) for r in sm.sorted_by(matrix_a(spark, cells), "i", "k").collect()]
    assert found == sorted(cells)
