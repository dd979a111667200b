"""Tile product: cut A, B and C into blocks and add up products of blocks.

Tiles are rows of a DataFrame and Spark's join brings together those that share a block
of k: strips of tiles rather than single ones, since a tile that stands beside each of its
partners is repeated for each. The only Python here is the arithmetic on a strip of B's
tiles and the tiles of A that meet it, a bounded number of cells of both at a time.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..schema import require, resolve_duplicates, wrap_int32 as wrap
from .layout import from_blocks, to_blocks
from .multiply import operand
from .skew import SKEW, deal, one_cell, shuffle_tasks, skew_join, slice_factors

# The kernel travels inside the task, so executors need numpy and pyarrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KERNELS = ("cells", "tiles")

# A tile pair goes through dense arrays when its products are more than 1/64 of the dense
# work, and cell by cell otherwise.
_DENSE_SHARE = 64

# A strip holds tiles of one block of k with so many cells, and one tile more at most.
_STRIP = 1 << 15

# Products of a strip that are made at once, and that a pair of tiles must have to be
# worth arrays of its own.
_AT_ONCE, _OWN = 1 << 20, 20_000

# Bytes of C tiles that a task adds up before it lets go of them, and cells it returns at once.
_KEPT, _RETURNED = 64 << 20, 1 << 16


def to_tiles(
    coo: DataFrame,
    row: str,
    col: str,
    row_size: int,
    col_size: int,
    names: tuple[str, str] = ("ib", "kb"),
    *,
    duplicates: str = "sum",
) -> DataFrame:
    """``(ib, kb, tile)``, one record per non-empty block.

    `tile` is a sparse vector over the block in row-major order: ``x = il*col_size + kl``.
    """
    cells = resolve_duplicates(coo, (row, col), duplicates)
    addressed = to_blocks(cells, row, col, row_size, col_size, (*names, "_r", "_c"))
    place = (F.col("_r") * int(col_size) + F.col("_c")).alias("x")
    return (
        addressed.select(*names, F.struct(place, "v").alias("_e"))
        .groupBy(*names)
        .agg(F.collect_list("_e").alias("tile"))
    )


def _magnitude(values: np.ndarray) -> int:
    return max(abs(int(values.min())), abs(int(values.max())))


def _add_pair(total, seen, ax, av, bx, bv, size, modular):
    """Add one tile product to the flat C tile `total`; returns it with its new bound.

    `seen` bounds every number added up so far. It picks the type of `total`, so that no
    sum is rounded or wrapped unnoticed.
    """
    ib, kb, jb = size
    ar, ac = np.divmod(ax, kb)
    br, bc = np.divmod(bx, jb)
    per_k = np.bincount(br, minlength=kb)
    products = int(per_k[ac].sum())
    if products == 0:
        return total, seen
    # A cell may occur several times; its copies add up. So many products meet at most in a sum.
    copies = int(np.bincount(ax).max()) * int(np.bincount(bx).max())
    bound = _magnitude(av) * _magnitude(bv) * kb * copies
    seen += bound
    if seen < 1 << 53:
        kind = np.float64  # exact for whole numbers of this size
    elif modular or seen < 1 << 63:
        kind = np.int64  # wraps at 2^64, which modular arithmetic allows
    else:
        kind = object
    if total is None:
        total = np.zeros(ib * jb, dtype=kind)
    elif total.dtype != kind:
        total = total.astype(np.int64).astype(kind)
    if bound < 1 << 53 and products * _DENSE_SHARE > ib * kb * jb:
        left = np.zeros((ib, kb))
        right = np.zeros((kb, jb))
        np.add.at(left, (ar, ac), av)
        np.add.at(right, (br, bc), bv)
        dense = (left @ right).ravel()
        return total + (dense if kind is np.float64 else dense.astype(np.int64)), seen
    order = np.argsort(br, kind="stable")
    start = np.cumsum(per_k) - per_k
    times = per_k[ac]
    first = np.cumsum(times) - times
    pick = order[np.repeat(start[ac] - first, times) + np.arange(products)]
    value = np.repeat(av.astype(kind), times) * bv.astype(kind)[pick]
    np.add.at(total, np.repeat(ar, times) * jb + bc[pick], value)
    return total, seen


def _checked(found: np.ndarray) -> np.ndarray:
    """Sums as BIGINT."""
    if found.dtype == object and any(not -(1 << 63) <= x < 1 << 63 for x in found):
        raise OverflowError("sum of products outside the BIGINT range in block_matmul")
    return found.astype(np.int64)


def _cells_of(tile, total, ib, jb):
    """The non-zero cells ``(i, j, p)`` of a C tile."""
    at = np.flatnonzero(total)
    r, c = np.divmod(at, jb)
    return tile[0] * ib + r + 1, tile[1] * jb + c + 1, _checked(total[at])


def _lists(column: pa.ListArray):
    offsets = column.offsets.to_numpy()
    entries = column.values
    x = entries.field("x").to_numpy(zero_copy_only=False)
    v = entries.field("v").to_numpy(zero_copy_only=False)
    return offsets, x, v


class _Tiles:
    """Tiles of one block of k, end to end: numbers of the tiles, and their cells."""

    def __init__(self, parts, height, width):
        self.block = np.concatenate([p[0] for p in parts])
        self.size = np.concatenate([p[1] for p in parts])
        self.x = np.concatenate([p[2] for p in parts])
        self.v = np.concatenate([p[3] for p in parts])
        self.shape = height, width
        self._index = None

    def only(self, which: np.ndarray) -> _Tiles | None:
        """The tiles that `which` marks."""
        if which.all():
            return self
        cells = np.repeat(which, self.size)
        chosen = (self.block[which], self.size[which], self.x[cells], self.v[cells])
        return _Tiles([chosen], *self.shape) if which.any() else None

    def each(self):
        """``(block, x, v)`` of each tile."""
        ends = np.cumsum(self.size)
        for block, first, end in zip(self.block.tolist(), (ends - self.size).tolist(), ends.tolist()):
            yield block, self.x[first:end], self.v[first:end]

    def places(self):
        """0-based row and column of each cell: one of them in the matrix, that of k in its block."""
        r, c = np.divmod(self.x, self.shape[1])
        return r, c, np.repeat(self.block, self.size)

    def by_k(self):
        """Of B's tiles: cells per k, the first one of each, numbers of columns, the columns, and values."""
        if self._index is None:
            k, c, block = self.places()
            columns, number = np.unique(block * self.shape[1] + c, return_inverse=True)
            order = np.argsort(k, kind="stable")
            per_k = np.bincount(k, minlength=self.shape[0])
            self._index = per_k, np.cumsum(per_k) - per_k, number[order], columns, self.v[order]
        return self._index


def _sums(code, value, n):
    """Sums by `code`, all below `n`: the codes with a sum other than 0, and the sums."""
    if n <= 4 * len(code) + _RETURNED:
        if value.dtype == np.float64:
            total = np.bincount(code, weights=value, minlength=n)
        else:
            total = np.zeros(n, dtype=value.dtype)
            np.add.at(total, code, value)
        at = np.flatnonzero(total)
        return at, total[at]
    order = np.argsort(code, kind="stable")
    code = code[order]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    total = np.add.reduceat(value[order], first)
    some = np.flatnonzero(total)
    return code[first[some]], total[some]


def _multiply_sparse(a: _Tiles, b: _Tiles, modular: bool):
    """Sums ``(i, j, p)`` of the products of all cells of both that share a k."""
    per_k, start, number, columns, bv = b.by_k()
    r, c, block = a.places()
    rows, times, av = block * a.shape[0] + r, per_k[c], a.v
    met = times > 0
    rows, c, times, av = rows[met], c[met], times[met], av[met]
    part = (np.cumsum(times) - times) // _AT_ONCE
    cuts = np.flatnonzero(np.diff(part)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, len(rows)]):
        if lo == hi:
            continue
        n, some = times[lo:hi], av[lo:hi]
        products = int(n.sum())
        bound = _magnitude(some) * _magnitude(bv) * products
        if bound < 1 << 53:
            kind = np.float64  # exact for whole numbers of this size
        elif modular or bound < 1 << 63:
            kind = np.int64  # wraps at 2^64, which modular arithmetic allows
        else:
            kind = object
        pick = np.repeat(start[c[lo:hi]] - (np.cumsum(n) - n), n) + np.arange(products)
        own, place = np.unique(rows[lo:hi], return_inverse=True)
        code = np.repeat(place, n) * len(columns) + number[pick]
        value = np.repeat(some.astype(kind), n) * bv.astype(kind)[pick]
        at, total = _sums(code, value, len(own) * len(columns))
        at, j = np.divmod(at, len(columns))
        yield own[at] + 1, columns[j] + 1, _checked(total)


def _tile_kernel(ib: int, kb: int, jb: int, modular: bool):
    """Sums of products of strips, each a run of B's tiles (side 0) and a run of A's (side 1)."""

    def multiply(a, b, totals):
        # Tiles that may be full enough for arrays meet one by one, all others at once.
        full_a = (a.size * _DENSE_SHARE > ib * kb) & (a.size * jb >= _OWN)
        full_b = (b.size * _DENSE_SHARE > kb * jb) & (b.size * ib >= _OWN)
        if not (full_a.any() and full_b.any()):
            yield from _multiply_sparse(a, b, modular)
            return
        thin_a, thin_b, full_a, full_b = a.only(~full_a), b.only(~full_b), a.only(full_a), b.only(full_b)
        if thin_a is not None:
            yield from _multiply_sparse(thin_a, b, modular)
        if thin_b is not None:
            yield from _multiply_sparse(full_a, thin_b, modular)
        for row, ax, av in full_a.each():
            for column, bx, bv in full_b.each():
                total, seen = totals.get((row, column), (None, 0))
                total, seen = _add_pair(total, seen, ax, av, bx, bv, (ib, kb, jb), modular)
                if total is not None:
                    totals[row, column] = total, seen
            if len(totals) * ib * jb * 8 > _KEPT:
                yield from flushed(totals)

    def flushed(totals):
        for tile, (total, _) in totals.items():
            yield _cells_of(tile, total, ib, jb)
        totals.clear()

    def sums(batches):
        totals, parts, strip, closed = {}, [], None, False
        for batch in batches:
            side, block = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("side", "block"))
            offsets, x, v = _lists(batch.column("tile"))
            cuts = np.flatnonzero(np.diff(side)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(side)]):
                if lo == hi:
                    continue
                cells = slice(offsets[lo], offsets[hi])
                part = block[lo:hi], np.diff(offsets[lo : hi + 1]), x[cells], v[cells]
                if side[lo] == 0:
                    parts, closed = [*([] if closed else parts), part], False
                else:
                    strip = strip if closed else _Tiles(parts, kb, jb)
                    closed = True
                    yield from multiply(_Tiles([part], ib, kb), strip, totals)
        yield from flushed(totals)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*waiting)], ["i", "j", "p"])

        waiting, n = [], 0
        for found in sums(batches):
            waiting.append(found)
            n += len(found[0])
            if n >= _RETURNED:
                yield batch()
                waiting, n = [], 0
        if n:
            yield batch()

    return run


def block_matmul(
    a: DataFrame,
    b: DataFrame,
    ib: int,
    kb: int,
    jb: int,
    *,
    kernel: str = "tiles",
    duplicates: str = "sum",
    wrap_int32: bool = False,
    skew: str = "auto",
) -> DataFrame:
    """C = A * B over tiles of ``ib x kb`` and ``kb x jb`` cells; zeros are dropped.

    ``kernel="tiles"`` joins strips of whole tiles by block of k, and numpy adds up their
    products in the task that joined them, so that each tile travels once (in a hot block
    of k, once per slice of the other side) and sums alone after that. ``kernel="cells"``
    is `matmul` on tile addresses: it joins on k and sums per place in C's tile, all in the
    JVM.
    """
    require(kernel, KERNELS, "kernel")
    a = operand(a, "i", "k", duplicates, None, wrap_int32)
    b = operand(b, "k", "j", duplicates, None, wrap_int32)
    return (_by_tiles if kernel == "tiles" else _by_cells)(a, b, (ib, kb, jb), wrap_int32, skew)


def choose_grid(tasks: int, a: float, b: float, c: float) -> tuple[int, int, int]:
    """Rows, columns and slices of k of a grid of about `tasks` that moves the least data.

    `a`, `b` and `c` are the sizes of both factors and of the result: A's tiles go to every
    column of the grid and B's to every row, and each slice of k makes its own part of C.
    """
    best = None
    for rows in range(1, tasks + 1):
        for columns in range(1, tasks // rows + 1):
            slices = tasks // (rows * columns)
            if rows * columns * slices * 4 < tasks * 3:
                continue  # too many tasks without work
            cost = a * columns + b * rows + c * slices, -rows * columns * slices
            if best is None or cost < best[0]:
                best = cost, (rows, columns, slices)
    return best[1]


def deal_to_grid(left: DataFrame, right: DataFrame, grid: tuple[int, int, int]) -> tuple[DataFrame, DataFrame]:
    """Tiles ``(ib, kb, ..)`` and ``(kb, jb, ..)``, each in the places of the grid that need it.

    A tile of A goes to one row and slice and every column, one of B to one column and slice
    and every row; so a pair meets in exactly one place, column ``_task``, which is a task.
    """
    rows, columns, slices = (F.lit(n).cast("bigint") for n in grid)
    tasks = grid[0] * grid[1] * grid[2]
    zero = F.lit(0).cast("bigint")
    row, column, inner = (F.pmod(F.xxhash64(c), n) for c, n in (("ib", rows), ("jb", columns), ("kb", slices)))

    def place(r: Column, c: Column) -> Column:
        return (inner * rows + r) * columns + c

    left = left.withColumn("_c", F.explode(F.sequence(zero, columns - 1)))
    right = right.withColumn("_r", F.explode(F.sequence(zero, rows - 1)))
    left = deal(left, tasks, "_task", place(row, F.col("_c"))).drop("_c")
    return left, deal(right, tasks, "_task", place(F.col("_r"), column)).drop("_r")


def grid_matmul(
    a: DataFrame,
    b: DataFrame,
    ib: int,
    kb: int,
    jb: int,
    grid: tuple[int, int, int],
    *,
    duplicates: str = "sum",
    wrap_int32: bool = False,
) -> DataFrame:
    """C = A * B over tiles on a grid of ``rows x columns x slices of k`` tasks; zeros are dropped.

    Tiles are repeated, ``tiles(A) * columns + tiles(B) * rows`` of them travel, and pairs
    meet where they are multiplied: nothing is shuffled between the join and the products.
    :func:`block_matmul` moves each tile once, but the sums of each block of k; a grid with
    few slices of k moves fewer of them. Hashes deal out the tiles, so a dense band of rows,
    columns or k is spread over the grid's other two directions.
    """
    if min(grid) < 1:
        raise ValueError("a grid has at least one row, one column and one slice")
    a = operand(a, "i", "k", duplicates, None, wrap_int32)
    b = operand(b, "k", "j", duplicates, None, wrap_int32)
    left = to_tiles(a, "i", "k", ib, kb, ("ib", "kb"), duplicates="unique").withColumnRenamed("tile", "at")
    right = to_tiles(b, "k", "j", kb, jb, ("kb", "jb"), duplicates="unique").withColumnRenamed("tile", "bt")
    return _multiply_strips(*deal_to_grid(left, right, grid), ["_task", "kb"], (ib, kb, jb), wrap_int32)


def _by_cells(a, b, size, wrap_int32, skew):
    ib, kb, jb = size
    left = to_blocks(a, "i", "k", ib, kb, ("ib", "kb", "il", "kl"))
    right = to_blocks(b, "k", "j", kb, jb, ("kb", "jb", "kl", "jl"))
    joined = skew_join(
        left.withColumnRenamed("v", "av"),
        right.withColumnRenamed("v", "bv"),
        ["kb", "kl"],
        left_cells=one_cell("av"),
        right_cells=one_cell("bv"),
        left_split=["ib", "il"],
        right_split=["jb", "jl"],
        skew=skew,
    )
    product = F.col("av") * F.col("bv")
    if wrap_int32:
        product = wrap(product)
    total = F.sum(product)
    tiles = joined.groupBy("ib", "jb", "il", "jl").agg(
        (wrap(total) if wrap_int32 else total).alias("v")
    )
    return from_blocks(tiles.where(F.col("v") != 0), "i", "j", ib, jb, ("ib", "jb", "il", "jl"))


def _by_tiles(a, b, size, wrap_int32, skew):
    require(skew, SKEW, "skew")
    ib, kb, jb = size
    left = to_tiles(a, "i", "k", ib, kb, ("ib", "kb"), duplicates="unique").withColumnRenamed("tile", "at")
    right = to_tiles(b, "k", "j", kb, jb, ("kb", "jb"), duplicates="unique").withColumnRenamed("tile", "bt")
    if skew == "off":
        tasks, keys = shuffle_tasks(a), ["_task", "kb"]
        left, right = (deal(side, tasks, "_task", F.xxhash64("kb")) for side in (left, right))
    else:
        keys = ["_task", "kb", "_ls", "_rs"]
        left, right = slice_factors(
            left,
            right,
            ["kb"],
            left_cells=F.size("at"),
            right_cells=F.size("bt"),
            left_split=["ib"],
            right_split=["jb"],
            task="_task",
        )
    return _multiply_strips(left, right, keys, size, wrap_int32)


def _strips(tiles: DataFrame, keys: list[str], block: str, tile: str) -> DataFrame:
    """Tiles that share `keys` as lists of about ``_STRIP`` cells, in the tasks they are in."""
    before = F.sum(F.size(tile).cast("bigint")).over(W.partitionBy(*keys).orderBy(block))
    strip = F.floor((before - F.size(tile)) / _STRIP).alias("_strip")
    cut = tiles.select(*keys, strip, F.struct(F.col(block).alias("block"), F.col(tile).alias("tile")).alias("_t"))
    return cut.groupBy(*keys, "_strip").agg(F.collect_list("_t").alias(tile)).drop("_strip")


def _multiply_strips(left, right, keys, size, wrap_int32):
    """Sums over the tiles of both sides, dealt out by ``_task``, that share `keys`."""
    met = _strips(left, keys, "ib", "at").join(_strips(right, keys, "jb", "bt"), keys)

    def of(side: int, tiles: str) -> Column:
        return F.transform(tiles, lambda t: F.struct(F.lit(side).alias("side"), t["block"].alias("block"), t["tile"].alias("tile")))

    rows = met.select(F.inline(F.concat(of(0, "bt"), of(1, "at"))))
    cells = rows.mapInArrow(_tile_kernel(*size, wrap_int32), "i long, j long, p long")
    p = F.col("p")
    total = F.sum(wrap(p) if wrap_int32 else p)
    merged = cells.groupBy("i", "j").agg((wrap(total) if wrap_int32 else total).alias("v"))
    return merged.where(F.col("v") != 0)
