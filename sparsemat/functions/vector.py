"""Sparse vectors as Column expressions: all built-in, all linear or n log n in the entries.

These work on one record at a time. Sums over many records (a row of a product, say)
are aggregations over cells instead and live in `operators`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_Col = Column | str


def _col(c: _Col) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _entry(x: Column, v: Column) -> Column:
    return F.struct(x.alias("x"), v.alias("v"))


def vec_scale(vec: _Col, p: Column | int) -> Column:
    """Every value times `p`."""
    p = p if isinstance(p, Column) else F.lit(p)
    p = p.cast("bigint")
    return F.transform(_col(vec), lambda e: _entry(e["x"], e["v"] * p))


def vec_drop_zeros(vec: _Col) -> Column:
    """Without explicit zeros."""
    return F.filter(_col(vec), lambda e: e["v"] != 0)


def vec_nnz(vec: _Col) -> Column:
    """Number of stored entries."""
    return F.size(_col(vec))


def vec_to_dense(vec: _Col, n: Column | int, offset: Column | int = 0) -> Column:
    """Dense ``ARRAY<BIGINT>`` of the indices ``offset+1 .. offset+n``.

    One pass over the sorted entries: each puts down the zeros between its predecessor
    and itself. An index outside the range fails the query.
    """
    n = (n if isinstance(n, Column) else F.lit(n)).cast("bigint")
    offset = (offset if isinstance(offset, Column) else F.lit(offset)).cast("bigint")
    zero = F.lit(0).cast("bigint")

    def fill(s: Column) -> Column:
        def step(e: Column, at: Column) -> Column:
            before = F.coalesce(F.get(s, at - 1)["x"], offset)
            gap = (e["x"] - before - 1).cast("int")
            return F.array(F.array_repeat(zero, gap), F.array(e["v"]))

        last = F.coalesce(F.get(s, F.size(s) - 1)["x"], offset)
        tail = F.array_repeat(zero, (offset + n - last).cast("int"))
        # runs of zeros and values by turns, put together in one copy
        dense = F.flatten(F.concat(F.flatten(F.transform(s, step)), F.array(tail)))
        first = F.coalesce(F.get(s, F.lit(0))["x"], offset + 1)
        inside = (first > offset) & (last <= offset + n)
        failure = F.raise_error(F.lit("vector index outside the dense range")).cast("array<bigint>")
        return F.when(inside, dense).otherwise(failure)

    # Bound by a transform of one element: named inside a lambda, the sort would be done
    # again for every entry.
    return F.transform(F.array(F.sort_array(_col(vec))), fill)[0]


def vec_from_dense(values: _Col, offset: Column | int = 0) -> Column:
    """Sparse form of a dense array; zeros are left out."""
    offset = (offset if isinstance(offset, Column) else F.lit(offset)).cast("bigint")
    # Nearly all of a dense array may be zeros, so an entry is made for the others alone.
    found = F.transform(
        _col(values), lambda v, at: F.when(v != 0, _entry(at.cast("bigint") + 1 + offset, v.cast("bigint")))
    )
    return F.array_compact(found)


def _merge(u: Column, w: Column, combine) -> Column:
    # Both sides become maps once; map_zip_with aligns them by hash.
    return F.map_zip_with(F.map_from_entries(u), F.map_from_entries(w), combine)


def sparse_dot(u: _Col, w: _Col) -> Column:
    """Dot product of two sparse vectors (0 when they share no index)."""
    zero = F.lit(0).cast("bigint")
    products = F.map_values(_merge(_col(u), _col(w), lambda x, a, b: F.coalesce(a * b, zero)))
    return F.aggregate(products, zero, lambda acc, p: acc + p)


def vec_axpy(p: Column | int, x: _Col, y: _Col) -> Column:
    """``p*x + y``, zeros left out."""
    p = (p if isinstance(p, Column) else F.lit(p)).cast("bigint")
    zero = F.lit(0).cast("bigint")
    merged = _merge(
        _col(x), _col(y), lambda k, a, b: F.coalesce(a * p, zero) + F.coalesce(b, zero)
    )
    entries = F.transform(F.map_entries(merged), lambda e: _entry(e["key"], e["value"]))
    return F.sort_array(vec_drop_zeros(entries))


def vec_text(vec: _Col) -> Column:
    """``x v x v `` with a blank after every number; an empty vector is empty text."""
    blank = F.lit(" ")
    return F.array_join(
        F.transform(
            _col(vec),
            lambda e: F.concat(e["x"].cast("string"), blank, e["v"].cast("string"), blank),
        ),
        "",
    )
