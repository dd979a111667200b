"""Products of sparse integer matrices.

All of them compute ``C(i,j) = sum over k of A(i,k) * B(k,j)`` and differ in the layout
they read and write and in how the work is cut:

=====================  =======================================  ==========================
function               input                                    work unit
=====================  =======================================  ==========================
matmul                 cells                                    one pair of cells
partial_products       cells                                    same, sum left to the caller
row_matmul             row vectors                              A cell x B row
outer_matmul           outer records (A column k, B row k)      segment x segment
scaled_matmul          scaled rows (i, a, B row)                A cell x B row
segmented_matmul       cells                                    segment x segment
block_matmul           cells                                    tile x tile
masked_matmul          cells and the wanted (i, j)              one wanted cell's pairs
=====================  =======================================  ==========================

Values are BIGINT. Spark's ANSI mode (on by default) turns an overflow into an error;
``wrap_int32=True`` computes in 32-bit two's complement instead.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import (
    DEFAULT_SEGMENT,
    DEFAULT_WIDTH,
    VECTOR,
    ZEROS,
    as_cells,
    check_bounds,
    require,
    resolve_duplicates,
    wrap_int32 as wrap,
)
from .layout import entries, gather_blocks, segment_of, segment_pairs, to_row_vectors
from .skew import SLICES_PER_TASK, deal, fits_broadcast, one_cell, shuffle_tasks, skew_join


def operand(
    df: DataFrame,
    row: str,
    col: str,
    duplicates: str,
    limits: tuple[int, int] | None = None,
    wrap_int32: bool = False,
) -> DataFrame:
    """A checked factor with one BIGINT cell per index pair."""
    cells = as_cells(df, row, col)
    if limits is not None:
        cells = check_bounds(cells, **{row: limits[0], col: limits[1]})
    if wrap_int32:
        cells = cells.withColumn("v", wrap(F.col("v")))
    cells = resolve_duplicates(cells, (row, col), duplicates)
    if wrap_int32 and duplicates == "sum":
        cells = cells.withColumn("v", wrap(F.col("v")))
    return cells


def _operands(a, b, duplicates, dims, wrap_int32):
    m, n, p = dims if dims is not None else (None, None, None)
    return (
        operand(a, "i", "k", duplicates, (m, n), wrap_int32),
        operand(b, "k", "j", duplicates, (n, p), wrap_int32),
    )


def _join_cells(a: DataFrame, b: DataFrame, skew: str) -> DataFrame:
    return skew_join(
        a.select("i", "k", F.col("v").alias("av")),
        b.select("k", "j", F.col("v").alias("bv")),
        ["k"],
        left_cells=one_cell("av"),
        right_cells=one_cell("bv"),
        left_split=["i"],
        right_split=["j"],
        skew=skew,
    )


def _product(a, b, wrap_int32):
    p = F.col(a) * F.col(b)
    return wrap(p) if wrap_int32 else p


def partial_products(
    a: DataFrame,
    b: DataFrame,
    *,
    duplicates: str = "sum",
    wrap_int32: bool = False,
    dims: tuple[int, int, int] | None = None,
    skew: str = "auto",
) -> DataFrame:
    """Every single product ``(k, i, j, p)``, not yet summed."""
    a, b = _operands(a, b, duplicates, dims, wrap_int32)
    return _join_cells(a, b, skew).select("k", "i", "j", _product("av", "bv", wrap_int32).alias("p"))


def merge_partials(
    partials: DataFrame, *, zeros: str = "structural", wrap_int32: bool = False
) -> DataFrame:
    """Sum partial products to ``(i, j, v)``; Spark pre-sums before its shuffle."""
    require(zeros, ("structural", "drop"), "zeros")
    cells = partials.groupBy("i", "j").agg(F.sum("p").alias("v"))
    if wrap_int32:
        cells = cells.withColumn("v", wrap(F.col("v")))
    return cells.where(F.col("v") != 0) if zeros == "drop" else cells


def _numbers_to(n: Column) -> Column:
    """One row per number ``0 .. n-1``."""
    return F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))


def _rows_by_range(a: DataFrame, lists: DataFrame, tasks: int) -> DataFrame:
    """``(i, seg)`` for each row of A and each ``seg`` of `lists`."""
    # Rows and ranges are spread over a grid of tasks; each pair meets in one place of it.
    side = F.lit(math.isqrt(tasks - 1) + 1).cast("bigint")
    rows = a.select("i").distinct().withColumn("_r", F.pmod(F.xxhash64("i"), side))
    ranges = lists.select("seg").withColumn("_c", F.pmod(F.xxhash64("seg"), side))
    return (
        rows.withColumn("_c", _numbers_to(side))
        .join(ranges.withColumn("_r", _numbers_to(side)), ["_r", "_c"])
        .select("i", "seg")
    )


def _fill_support(c: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """C with a zero for each missing (i, j) whose row i of A and column j of B are non-empty.

    The zeros are as many as a dense result has, so they are made in the last step and never
    shuffled. What meets before are records per row and range of columns: C's cells there
    (if any), then the list of B's columns there.
    """
    tasks = shuffle_tasks(c)
    zero = F.lit(0).cast("bigint")
    lists = (
        b.select("j")
        .distinct()
        .withColumn("seg", segment_of("j", DEFAULT_SEGMENT))
        .groupBy("seg")
        .agg(F.collect_list("j").alias("js"))
    )
    filled = _rows_by_range(a, lists, tasks).join(
        to_row_vectors(c, "i", "j", duplicates="unique", width=DEFAULT_SEGMENT), ["i", "seg"], "left"
    )
    # Few ranges must still keep all tasks busy: each is then split by a salt of the row, and
    # its list repeated per salt. Many ranges need no salt.
    count = F.greatest(lists.agg(F.count("seg").alias("n")).scalar(), F.lit(1))
    salts = F.ceil(F.lit(SLICES_PER_TASK * tasks) / count)
    cells = F.coalesce("vec", F.array().cast(VECTOR))
    missing = F.array_except("js", F.transform(cells, lambda e: e["x"]))
    zeros = F.transform(missing, lambda j: F.struct(j.alias("x"), zero.alias("v")))
    # Dealt out by a given number: merged by bytes, a few tasks would make all the zeros.
    salted = filled.withColumn("_s", F.pmod(F.xxhash64("i"), salts)).repartition(tasks, "seg", "_s")
    repeated = lists.withColumn("_s", _numbers_to(salts)).repartition(tasks, "seg", "_s")
    return (
        salted.join(repeated, ["seg", "_s"])
        .select("i", F.inline(F.concat(cells, zeros)))
        .toDF("i", "j", "v")
    )


def matmul(
    a: DataFrame,
    b: DataFrame,
    *,
    zeros: str = "structural",
    duplicates: str = "sum",
    wrap_int32: bool = False,
    dims: tuple[int, int, int] | None = None,
    skew: str = "auto",
) -> DataFrame:
    """C = A * B on cells ``(i,k,v)`` and ``(k,j,v)``; returns ``(i,j,v)``.

    `zeros`: ``structural`` keeps a cell when some k has both factors, even if the sum is
    0; ``drop`` keeps non-zero cells only; ``dense_support`` has every (i, j) with a
    non-empty row i of A and a non-empty column j of B.
    `duplicates`: see :func:`sparsemat.schema.resolve_duplicates`. ``unique`` saves a
    shuffle of each factor. A product is linear in each cell, so it leaves copies, if there
    are any, to the last sum, with the same result as ``sum``: better where copies are few,
    worse where each cell has many and their products multiply.
    `dims`: optional (rows of A, columns of A, columns of B), checked.
    `skew`: see :func:`sparsemat.operators.skew.skew_join`.
    """
    require(zeros, ZEROS, "zeros")
    a, b = _operands(a, b, duplicates, dims, wrap_int32)
    products = _join_cells(a, b, skew).select("i", "j", _product("av", "bv", wrap_int32).alias("p"))
    kept = "structural" if zeros == "structural" else "drop"
    c = merge_partials(products, zeros=kept, wrap_int32=wrap_int32)
    return _fill_support(c, a, b) if zeros == "dense_support" else c


def vector_sum(
    products: DataFrame,
    *,
    task: str | None = None,
    zeros: str = "structural",
    wrap_int32: bool = False,
    width: int = DEFAULT_WIDTH,
) -> DataFrame:
    """Sum products ``(i, j, p)`` to row vectors ``(i, seg, vec)`` with one exchange.

    Rows go to the task of their row and column range; there they are summed cell by cell
    and the sums collected, as both groupings contain that pair. A row with a large part of
    all products is spread over its ranges, and a range is at most `width` sums. If `task`
    names the column of :func:`sparsemat.operators.skew.skew_join`, products are first
    summed in the task that made them, so that at most one row per cell and task travels.
    """
    require(zeros, ("structural", "drop"), "zeros")
    if task is not None:
        products = products.groupBy(task, "i", "j").agg(F.sum("p").alias("p"))
    placed = products.select("i", segment_of("j", width).alias("seg"), "j", "p").repartition("i", "seg")
    cells = placed.groupBy("i", "seg", "j").agg(F.sum("p").alias("v"))
    if wrap_int32:
        cells = cells.withColumn("v", wrap(F.col("v")))
    if zeros == "drop":
        cells = cells.where(F.col("v") != 0)
    return cells.groupBy("i", "seg").agg(entries("j", "v").alias("vec"))


def _result(products, result, zeros, wrap_int32, width, task=None):
    require(result, ("cells", "rows"), "result")
    if result == "cells":
        return merge_partials(products, zeros=zeros, wrap_int32=wrap_int32)
    return vector_sum(products, task=task, zeros=zeros, wrap_int32=wrap_int32, width=width)


def row_matmul(
    a_rows: DataFrame,
    b_rows: DataFrame,
    *,
    zeros: str = "drop",
    empty_rows: str = "drop",
    duplicates: str = "unique",
    wrap_int32: bool = False,
    width: int = DEFAULT_WIDTH,
    skew: str = "auto",
) -> DataFrame:
    """Product of row vectors ``(i, vec)`` and ``(k, vec)`` as row vectors ``(i, seg, vec)``.

    Row i of C is the sum over k of A(i,k) times B's row k. Only A's cells and B's vectors
    are shuffled to meet. The order of records and of entries inside them is irrelevant.

    ``empty_rows="keep"`` adds an empty vector (segment 0) for a row of A whose product
    row is empty. `duplicates` is for records that may hold an index more than once.
    """
    require(zeros, ("structural", "drop"), "zeros")
    require(empty_rows, ("drop", "keep"), "empty_rows")
    cells = a_rows.select("i", F.inline("vec")).toDF("i", "k", "av")
    b_vec = b_rows.select("k", F.col("vec").alias("bv"))
    if duplicates != "unique":
        cells = resolve_duplicates(cells, ("i", "k"), duplicates, "av")
        b_cells = b_rows.select("k", F.inline("vec")).toDF("k", "j", "v")
        b_vec = to_row_vectors(b_cells, "k", "j", duplicates=duplicates, width=width).select(
            "k", F.col("vec").alias("bv")
        )
    if wrap_int32:
        cells = cells.withColumn("av", wrap(F.col("av")))
    scaled = skew_join(
        cells,
        b_vec,
        ["k"],
        left_cells=one_cell("av"),
        right_cells=F.size("bv"),
        left_split=["i"],
        right_split=["bv"],
        skew=skew,
        task="_task",
    )
    products = _expand(scaled, "av", wrap_int32, "_task")
    rows = vector_sum(products, task="_task", zeros=zeros, wrap_int32=wrap_int32, width=width)
    if empty_rows == "drop":
        return rows
    kept = a_rows.select("i").distinct().join(rows, "i", "left")
    zero = F.lit(0).cast("bigint")
    return kept.select(
        "i", F.coalesce("seg", zero).alias("seg"), F.coalesce("vec", F.array().cast(VECTOR)).alias("vec")
    )


def _expand(scaled: DataFrame, factor: str, wrap_int32: bool, *kept: str) -> DataFrame:
    """``(i, factor, bv)`` to products ``(i, j, p)``, with the columns `kept`."""
    flat = scaled.select("i", F.col(factor).alias("_f"), *kept, F.inline("bv"))
    if wrap_int32:
        flat = flat.withColumn("v", wrap(F.col("v"))).withColumn("_f", wrap(F.col("_f")))
    return flat.select("i", F.col("x").alias("j"), _product("_f", "v", wrap_int32).alias("p"), *kept)


# Entries of a vector that a piece of a record may hold.
_PIECE = 1024


def _pieces(vec: str) -> Column:
    """The vector in pieces, at least one."""
    zero = F.lit(0).cast("int")
    starts = F.sequence(zero, F.greatest(F.size(vec) - 1, zero), F.lit(_PIECE))
    return F.explode(F.transform(starts, lambda at: F.slice(F.col(vec), at + 1, F.lit(_PIECE))))


def _cut(records: DataFrame, *vectors: str, task: str = "_task") -> DataFrame:
    """Records with their vectors cut into pieces that are dealt out by content.

    A line that was written elsewhere may hold a whole column and a whole row of a matrix,
    the work of many tasks. The records themselves are small beside the products they make.
    """
    rest = [c for c in records.columns if c not in vectors]
    for vec in vectors:
        records = records.select(*(c for c in records.columns if c != vec), _pieces(vec).alias(vec))
    return deal(records, shuffle_tasks(records), task, F.xxhash64(*rest, *vectors))


def outer_matmul(
    records: DataFrame,
    *,
    result: str = "cells",
    zeros: str = "structural",
    wrap_int32: bool = False,
    width: int = DEFAULT_WIDTH,
    bounded: bool = False,
    task: str | None = None,
) -> DataFrame:
    """Sum of outer products over records with vectors `av` (of A) and `bv` (of B).

    The two vectors are unfolded one after the other, so no task ever holds a list of all
    pairs. Several records per k, as `segment_pairs` makes them, simply add up. Where the
    segment numbers are known, the records of one block of C are laid side by side first.

    Records from elsewhere may be long, so they are cut and dealt out. ``bounded=True`` says
    that none is, as in those made by `cogroup_outer` with short segments: they stay where
    they are. So do records that carry the column `task` of a join that made them.
    """
    require(zeros, ("structural", "drop"), "zeros")
    if task is None and not (bounded and result == "cells"):
        task = "_task"
        if {"sa", "sb", "k"} <= set(records.columns):
            records = gather_blocks(records.select("sa", "sb", "k", "av", "bv"), "sa", "sb", "k", task)
        else:
            records = _cut(records.select("av", "bv"), "av", "bv", task=task)
    kept = [task] if task and result == "rows" else []
    unfolded = records.select(*kept, F.inline("av"), "bv").toDF(*kept, "i", "p", "bv")
    return _result(_expand(unfolded, "p", wrap_int32, *kept), result, zeros, wrap_int32, width, *kept)


def scaled_matmul(
    scaled: DataFrame,
    *,
    result: str = "cells",
    zeros: str = "structural",
    wrap_int32: bool = False,
    width: int = DEFAULT_WIDTH,
    bounded: bool = False,
    task: str | None = None,
) -> DataFrame:
    """Product from scaled rows ``(i, p, bv)``; `bounded` and `task` as in :func:`outer_matmul`."""
    require(zeros, ("structural", "drop"), "zeros")
    if task is None and not (bounded and result == "cells"):
        task = "_task"
        scaled = _cut(scaled.select("i", "p", "bv"), "bv", task=task)
    kept = [task] if task and result == "rows" else []
    return _result(_expand(scaled, "p", wrap_int32, *kept), result, zeros, wrap_int32, width, *kept)


def segmented_matmul(
    a: DataFrame,
    b: DataFrame,
    la: int = DEFAULT_SEGMENT,
    lb: int = DEFAULT_SEGMENT,
    *,
    result: str = "cells",
    zeros: str = "structural",
    duplicates: str = "sum",
    wrap_int32: bool = False,
    width: int = DEFAULT_WIDTH,
    skew: str = "auto",
    by: str = "range",
) -> DataFrame:
    """Outer products of segments: no record expands to more than ``la * lb`` products.

    `by` is that of :func:`segment_pairs`: segments by degree are as few as the cells allow,
    best where columns are short but for some. Pairs are multiplied in the task that joins
    them: a pair repeats both of its segments, which is more than its products as soon as
    segments are short.
    """
    task = "_task"
    pairs = segment_pairs(a, b, la, lb, duplicates=duplicates, skew=skew, by=by, task=task)
    return outer_matmul(pairs, result=result, zeros=zeros, wrap_int32=wrap_int32, width=width, task=task)


# Bits of the bitmap of wanted cells, and bits of one piece of it (fixed by Spark's bitmap
# functions): 2,048 pieces of 4 KiB, 8 MiB in all, however many cells are wanted.
_MASK_BITS, _PIECE_BITS = 1 << 26, 1 << 15


def _place_in_mask(on: Sequence[str]) -> tuple[Column, Column]:
    """Piece and bit of the cell that the columns `on` name."""
    place = F.pmod(F.xxhash64(*on), F.lit(_MASK_BITS))
    return F.shiftright(place, 15), place.bitwiseAND(F.lit(_PIECE_BITS - 1))


def mask_bits(wanted: DataFrame, on: Sequence[str] = ("i", "j")) -> DataFrame:
    """The bitmap of cells `on` as ``(piece, words)``, 512 words of 64 bits in a piece."""
    piece, bit = _place_in_mask(on)
    pieces = wanted.groupBy(piece.alias("piece")).agg(F.bitmap_construct_agg(bit).alias("bits"))
    word = lambda w: F.conv(F.hex(F.substring("bits", w * 8 + 1, F.lit(8))), 16, -10).cast("bigint")
    return pieces.select("piece", F.transform(F.sequence(F.lit(0), F.lit(511)), word).alias("words"))


# A word is eight bytes as they stand, and bits are counted from a byte's lowest.
_BIT_IS_SET = "shiftright(words[shiftright(_bit, 6)], (7 - (shiftright(_bit, 3) & 7)) * 8 + (_bit & 7)) & 1 = 1"


def _beside_mask(rows: DataFrame, wanted: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    piece, bit = _place_in_mask(on)
    placed = rows.withColumn("_piece", piece).withColumn("_bit", bit.cast("int"))
    return placed.join(F.broadcast(mask_bits(wanted, on).withColumnRenamed("piece", "_piece")), "_piece", how)


def maybe_wanted(rows: DataFrame, wanted: DataFrame, on: Sequence[str] = ("i", "j")) -> DataFrame:
    """Rows whose cell has its bit set: all of the wanted ones and few others.

    The bitmap has a proven size, so it may be broadcast whatever the mask's own size, and
    rows (products, say) that nobody asked for are dropped in the task that makes them. With
    w wanted cells, one of 2**26 / w others has a bit in common; an exact semi-join must
    follow. Columns of both sides must have the same types.
    """
    return _beside_mask(rows, wanted, on, "inner").where(_BIT_IS_SET).select(*rows.columns)


def surely_unwanted(rows: DataFrame, wanted: DataFrame, on: Sequence[str] = ("i", "j")) -> DataFrame:
    """The rows that :func:`maybe_wanted` drops."""
    return _beside_mask(rows, wanted, on, "left").where(f"NOT coalesce({_BIT_IS_SET}, false)").select(*rows.columns)


# Bits of a column's place in a list of wanted cells, which is a SMALLINT of two bytes.
_PLACE_BITS = 15


def _fill_listed(c: DataFrame, a: DataFrame, b: DataFrame, pairs: DataFrame) -> DataFrame:
    """The cells of C that `pairs` lists, and zeros where C lacks one whose row and column are non-empty.

    Listed cells may be as many as a dense result has. They are shuffled as sets of places
    per row and range of columns, to be united and to meet the list of B's columns there;
    what C has comes to the sets, and zeros are made in the last step.
    """
    tasks = shuffle_tasks(c)
    width = 1 << _PLACE_BITS
    place = (F.col("j") - 1).bitwiseAND(F.lit(width - 1)).cast("smallint")

    def ranged(cells: DataFrame) -> DataFrame:
        return cells.withColumn("seg", F.shiftright(F.col("j") - 1, _PLACE_BITS))

    wanted = ranged(pairs).groupBy("i", "seg").agg(F.collect_set(place).alias("js"))
    columns = ranged(b.select("j")).groupBy("seg").agg(F.collect_set(place).alias("own"))
    # Of a range with most of its columns the others are kept: each record looks up the shorter list.
    most = F.size("own") > width // 2
    others = F.array_except(F.sequence(*(F.lit(n).cast("smallint") for n in (0, width - 1, 1))), "own")
    columns = columns.select("seg", most.alias("most"), F.when(most, others).otherwise(F.col("own")).alias("own"))
    # What C has per row of A and range of B's columns, be it nothing: a semi-join on i would
    # move the sets once more.
    none = F.lit(None)
    marks = _rows_by_range(a, columns, tasks).select("i", "seg", none.cast("smallint").alias("x"), none.cast("bigint").alias("v"))
    cells = ranged(c).select("i", "seg", place.alias("x"), "v").unionByName(marks)
    entry = F.when(F.col("x").isNotNull(), F.struct("x", "v"))
    rows = wanted.join(cells.groupBy("i", "seg").agg(F.collect_list(entry).alias("vec")), ["i", "seg"])
    # As in _fill_support: few ranges must keep all tasks busy, and bytes say nothing of the zeros.
    count = F.greatest(columns.agg(F.count("seg").alias("n")).scalar(), F.lit(1))
    salts = F.ceil(F.lit(SLICES_PER_TASK * tasks) / count)
    rows = rows.withColumn("_s", F.pmod(F.xxhash64("i"), salts)).repartition(tasks, "seg", "_s")
    columns = columns.withColumn("_s", _numbers_to(salts)).repartition(tasks, "seg", "_s")
    js = F.when(F.col("most"), F.array_except("js", "own")).otherwise(F.array_intersect("js", "own"))
    met = rows.join(columns, ["seg", "_s"]).select("i", "seg", js.alias("js"), "vec")
    met = met.withColumn("hit", F.array_intersect(F.transform("vec", lambda e: e["x"]), "js"))
    cells = F.filter("vec", lambda e: F.array_contains("hit", e["x"]))
    zero = F.lit(0).cast("bigint")
    zeros = F.transform(F.array_except("js", "hit"), lambda x: F.struct(x.alias("x"), zero.alias("v")))
    flat = met.select("i", "seg", F.inline(F.concat(cells, zeros)))
    return flat.select("i", (F.col("seg") * width + F.col("x") + 1).alias("j"), "v")


def masked_matmul(
    a: DataFrame,
    b: DataFrame,
    pairs: DataFrame,
    *,
    via: str = "products",
    mask: str = "auto",
    zeros: str = "structural",
    duplicates: str = "sum",
    wrap_int32: bool = False,
    skew: str = "auto",
) -> DataFrame:
    """Only the cells listed in `pairs` ``(i, j)``.

    ``via="products"`` multiplies the rows and columns that occur in `pairs` and keeps the
    listed cells; it never costs more than the whole product. ``via="probes"`` works through
    the listed cells one by one, looking up the shorter of row i and column j in the other
    factor; it is cheaper when few cells are listed over many rows and columns.

    Products of other cells are dropped before any is summed or shuffled: by the list itself
    where Spark's size check lets it be broadcast, else by a bitmap of the list, whose size
    is fixed, and exactly after the sum. `mask` (``auto``, ``list``, ``bitmap``) chooses.

    ``structural`` and ``drop`` as in :func:`matmul`; ``dense_support`` returns every
    listed pair whose row of A and column of B are non-empty. A list that is no broadcast is
    as long as that result, and then meets the sums alone (unless `mask` says ``bitmap``).
    """
    require(zeros, ZEROS, "zeros")
    require(via, ("products", "probes"), "via")
    require(mask, ("auto", "list", "bitmap"), "mask")
    a, b = _operands(a, b, duplicates, None, wrap_int32)
    pairs = pairs.select(F.col("i").cast("bigint"), F.col("j").cast("bigint"))
    wanted = pairs.distinct()
    kept = "structural" if zeros == "structural" else "drop"
    if via == "products":
        products = _join_cells(
            a.join(pairs.select("i").distinct(), "i", "left_semi"),
            b.join(pairs.select("j").distinct(), "j", "left_semi"),
            skew,
        ).select("i", "j", _product("av", "bv", wrap_int32).alias("p"))
        if zeros == "dense_support" and mask == "auto" and not fits_broadcast(wanted):
            return _fill_listed(merge_partials(products, zeros=kept, wrap_int32=wrap_int32), a, b, pairs)
        if mask == "list" or (mask == "auto" and fits_broadcast(wanted)):
            # Products that nobody asked for need not be summed, let alone shuffled.
            products = products.join(wanted, ["i", "j"], "left_semi")
            c = merge_partials(products, zeros=kept, wrap_int32=wrap_int32)
        else:
            # Summed before the list is met: both sides of the semi-join then hold a cell at most once.
            c = merge_partials(maybe_wanted(products, wanted), zeros=kept, wrap_int32=wrap_int32)
            c = c.join(wanted, ["i", "j"], "left_semi")
    else:
        products = _probe(a, b, wanted, skew).select(
            "i", "j", _product("av", "bv", wrap_int32).alias("p")
        )
        c = merge_partials(products, zeros=kept, wrap_int32=wrap_int32)
    if zeros != "dense_support":
        return c
    listed = wanted.join(a.select("i").distinct(), "i", "left_semi")
    listed = listed.join(b.select("j").distinct(), "j", "left_semi")
    filled = listed.join(c, ["i", "j"], "left")
    return filled.select("i", "j", F.coalesce("v", F.lit(0).cast("bigint")).alias("v"))


def _probe(a: DataFrame, b: DataFrame, wanted: DataFrame, skew: str) -> DataFrame:
    """``(i, j, k, av, bv)`` for the wanted pairs, unfolding the shorter side of each."""
    a = a.select("i", "k", F.col("v").alias("av"))
    b = b.select("k", "j", F.col("v").alias("bv"))
    # Joins on a unique key only widen rows; adaptive execution splits their large partitions.
    # Unfolding multiplies rows, so it is the join that needs its keys counted.
    sized = wanted.join(a.groupBy("i").agg(F.count("av").alias("na")), "i")
    sized = sized.join(b.groupBy("j").agg(F.count("bv").alias("nb")), "j")
    by_row = skew_join(
        sized.where("na <= nb").select("i", "j"),
        a,
        ["i"],
        left_cells=F.lit(1),
        right_cells=one_cell("av"),
        left_split=["j"],
        right_split=["k"],
        skew=skew,
    )
    by_col = skew_join(
        sized.where("na > nb").select("i", "j"),
        b,
        ["j"],
        left_cells=F.lit(1),
        right_cells=one_cell("bv"),
        left_split=["i"],
        right_split=["k"],
        skew=skew,
    )
    columns = ("i", "j", "k", "av", "bv")
    return by_row.join(b, ["k", "j"]).select(*columns).unionByName(
        by_col.join(a, ["k", "i"]).select(*columns)
    )
