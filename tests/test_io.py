from __future__ import annotations

import glob

import pytest

import sparsemat as sm
from helpers import A_CELLS, B_CELLS, C_CELLS, QUERY_FAILURE, matrix_a, matrix_b, random_pair, rows, vectors


def _lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def _write(path, text):
    path.write_bytes(text.encode())
    return str(path)


def _texts(path):
    return sorted(
        line for f in glob.glob(f"{path}/**/part-*", recursive=True) for line in open(f, newline="").read().splitlines()
    )


A_TEXT = "\r\n".join("\t".join(map(str, c)) for c in A_CELLS) + "\r\n"


def test_read_coo_with_crlf(spark, tmp_path):
    cells = sm.read_coo(spark, _write(tmp_path / "a", A_TEXT))
    assert cells.columns == ["i", "k", "v"]
    assert rows(cells) == A_CELLS


def test_read_coo_of_two_files(spark, tmp_path):
    paths = [_write(tmp_path / "x", "1\t1\t5\n"), _write(tmp_path / "y", "2\t1\t-6\n")]
    assert rows(sm.read_coo(spark, paths, ("k", "j"))) == [(1, 1, 5), (2, 1, -6)]


@pytest.mark.parametrize("bad", ["1 2\t3", "1\t2", "1\t2\tx", "1\t\t3", "1\t2\t3\t4"])
def test_read_coo_is_strict(spark, tmp_path, bad):
    path = _write(tmp_path / "bad", f"1\t1\t5\n{bad}\n")
    with pytest.raises(QUERY_FAILURE, match="(?i)malformed"):
        sm.read_coo(spark, path).collect()
    assert rows(sm.read_coo(spark, path, mode="DROPMALFORMED")) == [(1, 1, 5)]


def test_read_coo_permissive_keeps_the_line(spark, tmp_path):
    path = _write(tmp_path / "bad", "1\t1\t5\n1\tx\t5\n")
    found = sm.read_coo(spark, path, mode="PERMISSIVE", corrupt="line").collect()
    assert {(r.v, r.line) for r in found} == {(5, None), (5, "1\tx\t5")}


def test_parse_coo_blanks_and_trailing_tokens(spark):
    lines = _lines(spark, "1\t2\t3", "  4   5 \t 6  ", "7 8 9 10 x", "1 2\t-3", "+1 2 3")
    assert rows(sm.parse_coo(lines)) == [(1, 2, -3), (1, 2, 3), (1, 2, 3), (4, 5, 6), (7, 8, 9)]


@pytest.mark.parametrize("bad", ["", "1 2", "1 2 x", "1.5 2 3", "9223372036854775808 1 1"])
def test_parse_coo_modes(spark, bad):
    lines = _lines(spark, "1 2 3", bad)
    with pytest.raises(QUERY_FAILURE, match="malformed line"):
        sm.parse_coo(lines).collect()
    assert rows(sm.parse_coo(lines, mode="DROPMALFORMED")) == [(1, 2, 3)]
    kept = sm.parse_coo(lines, mode="PERMISSIVE", corrupt="line")
    assert {tuple(r) for r in kept.collect()} == {(1, 2, 3, None), (None, None, None, bad)}


def test_parse_row_vectors(spark):
    lines = _lines(spark, "1 1 1 3 1", "2", "3\t7 -5 ", " 4 1 0")
    assert vectors(sm.parse_row_vectors(lines)) == [
        (1, [(1, 1), (3, 1)]), (2, []), (3, [(7, -5)]), (4, [(1, 0)]),
    ]


@pytest.mark.parametrize("bad", ["", "x", "1 2", "1 2 3 4", "1 2 y"])
def test_parse_row_vectors_modes(spark, bad):
    lines = _lines(spark, "1 2 3", bad)
    with pytest.raises(QUERY_FAILURE, match="malformed line"):
        sm.parse_row_vectors(lines).collect()
    assert vectors(sm.parse_row_vectors(lines, mode="DROPMALFORMED")) == [(1, [(2, 3)])]
    kept = sm.parse_row_vectors(lines, mode="PERMISSIVE").where("_corrupt_record is not null")
    assert [tuple(r) for r in kept.collect()] == [(None, None, bad)]


def _records(df):
    return sorted((r.n, [tuple(e) for e in r.av], [tuple(e) for e in r.bv]) for r in df.collect())


def test_parse_outer_records(spark):
    lines = _lines(spark, "2\t1 1 2 4 1 10 2 15 ", "1 5 6", "0 3 4", "0")
    assert _records(sm.parse_outer_records(lines)) == [
        (0, [], []),
        (0, [], [(3, 4)]),
        (1, [(5, 6)], []),
        (2, [(1, 1), (2, 4)], [(1, 10), (2, 15)]),
    ]


@pytest.mark.parametrize("bad", ["", "x", "-1 1 1", "2 1 1", "1 1 1 1", "1 1 z"])
def test_parse_outer_records_modes(spark, bad):
    lines = _lines(spark, "0 3 4", bad)
    with pytest.raises(QUERY_FAILURE, match="malformed line"):
        sm.parse_outer_records(lines).collect()
    assert _records(sm.parse_outer_records(lines, mode="DROPMALFORMED")) == [(0, [], [(3, 4)])]


def test_parse_scaled_rows(spark):
    lines = _lines(spark, "1 4\t1 10 2 15 ", "2 5\t")
    found = sorted((r.i, r.p, [tuple(e) for e in r.bv]) for r in sm.parse_scaled_rows(lines).collect())
    assert found == [(1, 4, [(1, 10), (2, 15)]), (2, 5, [])]
    with pytest.raises(QUERY_FAILURE, match="malformed line"):
        sm.parse_scaled_rows(_lines(spark, "1")).collect()


def test_coo_styles(spark, tmp_path):
    c = matrix_a(spark, A_CELLS[:2])
    sm.write_coo(c, str(tmp_path / "tab"))
    sm.write_coo(c, str(tmp_path / "pair"), style="pair")
    assert _texts(tmp_path / "tab") == ["1\t1\t1", "1\t2\t2"]
    assert _texts(tmp_path / "pair") == ["1 1\t1", "1 2\t2"]
    assert rows(sm.read_coo(spark, str(tmp_path / "tab"))) == A_CELLS[:2]
    assert rows(sm.parse_coo(sm.read_lines(spark, str(tmp_path / "pair")))) == A_CELLS[:2]
    with pytest.raises(QUERY_FAILURE, match="(?i)malformed"):
        sm.read_coo(spark, str(tmp_path / "pair")).collect()


def test_write_crlf(spark, tmp_path):
    sm.write_coo(matrix_a(spark, A_CELLS).coalesce(1), str(tmp_path / "o"), line_sep="\r\n")
    (part,) = glob.glob(str(tmp_path / "o" / "part-*"))
    assert open(part, newline="").read().count("\r\n") == 11


def test_sorted_output_is_in_order_over_all_files(spark, tmp_path):
    cells, _ = random_pair(5)
    path = str(tmp_path / "sorted")
    sm.write_coo(matrix_a(spark, cells), path, sort=True)
    found = []
    for part in sorted(glob.glob(f"{path}/part-*")):
        found += [tuple(map(int, line.split())) for line in open(part)]
    assert found == sorted(cells)


def test_format_fixtures(spark):
    a, b = matrix_a(spark, A_CELLS), matrix_b(spark, B_CELLS)
    row_lines = [r.value for r in sm.format_row_vectors(sm.to_row_vectors(a)).collect()]
    assert sorted(row_lines) == ["1\t1 1 2 2 3 3 ", "2\t1 4 2 5 ", "3\t1 7 2 8 3 9 ", "4\t1 10 2 11 3 12 "]
    outer = [r.value for r in sm.format_outer_records(sm.cogroup_outer(a, b)).collect()]
    assert sorted(outer) == [
        "3\t1 3 3 9 4 12 1 11 2 9 ",
        "4\t1 1 2 4 3 7 4 10 1 10 2 15 ",
        "4\t1 2 2 5 3 8 4 11 2 2 ",
    ]
    scaled = [r.value for r in sm.format_scaled_rows(sm.scaled_rows(a, b)).collect()]
    assert "2 4\t1 10 2 15 " in scaled and len(scaled) == 11


def test_row_vector_files(spark, tmp_path):
    a = matrix_a(spark, A_CELLS)
    path = str(tmp_path / "rows")
    sm.write_row_vectors(sm.to_row_vectors(a, width=2), path, sort=True)
    assert rows(sm.from_row_vectors(sm.read_row_vectors(spark, path))) == A_CELLS


def test_chain_of_jobs_through_files(spark, tmp_path):
    """Layout job to text, product job from text, as two separate runs would do it."""
    a = sm.read_coo(spark, _write(tmp_path / "a", A_TEXT))
    b = matrix_b(spark, B_CELLS)
    sm.write_row_vectors(sm.to_row_vectors(a), str(tmp_path / "ra"))
    sm.write_row_vectors(sm.to_row_vectors(b, "k", "j"), str(tmp_path / "rb"), "k")
    c = sm.row_matmul(
        sm.read_row_vectors(spark, str(tmp_path / "ra")), sm.read_row_vectors(spark, str(tmp_path / "rb"), "k")
    )
    sm.write_row_vectors(c, str(tmp_path / "c"))
    again = sm.from_row_vectors(sm.read_row_vectors(spark, str(tmp_path / "c")), "i", "j")
    assert rows(again) == C_CELLS


def test_outer_records_in_halves(spark, tmp_path):
    path = str(tmp_path / "outer")
    pairs = sm.segment_pairs(matrix_a(spark, A_CELLS), matrix_b(spark, B_CELLS), 2, 1)
    sm.write_outer_records(pairs, path, acol=3)
    upper = sm.read_outer_records(spark, f"{path}/half=A")
    assert len(_texts(f"{path}/half=A")) == 4 and upper.count() == 4
    both = sm.read_outer_records(spark, [f"{path}/half=A", f"{path}/half=B"])
    assert rows(sm.outer_matmul(both)) == C_CELLS


def test_outer_records_in_one_folder(spark, tmp_path):
    path = str(tmp_path / "outer")
    sm.write_outer_records(sm.cogroup_outer(matrix_a(spark, A_CELLS), matrix_b(spark, B_CELLS)), path)
    assert rows(sm.outer_matmul(sm.read_outer_records(spark, path))) == C_CELLS


def test_scaled_row_files(spark, tmp_path):
    path = str(tmp_path / "scaled")
    sm.write_scaled_rows(sm.scaled_rows(matrix_a(spark, A_CELLS), matrix_b(spark, B_CELLS)), path)
    assert rows(sm.scaled_matmul(sm.read_scaled_rows(spark, path))) == C_CELLS


def test_partials_in_buckets(spark, tmp_path):
    path = str(tmp_path / "partials")
    partials = sm.partial_products(matrix_a(spark, A_CELLS), matrix_b(spark, B_CELLS))
    sm.write_partials(partials, path, 2)
    assert sorted(f.rsplit("/", 1)[1] for f in glob.glob(f"{path}/k_bucket=*")) == ["k_bucket=0", "k_bucket=1"]
    stored = sm.read_partials(spark, path)
    assert rows(stored) == rows(partials)
    assert rows(sm.merge_partials(stored)) == C_CELLS
    # A bucket is one file here, not one per task.
    assert len(glob.glob(f"{path}/k_bucket=1/*.parquet")) == 1


def test_unknown_modes_are_rejected(spark, tmp_path):
    with pytest.raises(ValueError):
        sm.parse_coo(_lines(spark, "1 1 1"), mode="LAX")
    with pytest.raises(ValueError):
        sm.read_coo(spark, str(tmp_path), mode="LAX")
    with pytest.raises(ValueError):
        sm.format_coo(matrix_a(spark, A_CELLS), "csv")
