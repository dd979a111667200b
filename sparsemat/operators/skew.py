"""Equi-join that stays balanced when one key holds a large part of the rows.

Multiplying matrices joins on the shared index k, and the work of one k is the
*product* of its cells on both sides. Adaptive execution splits partitions that are
large in bytes; it does not see a key whose rows are few but whose pairs are many. So
the load of every key is counted first (column-pruned, aggregated before the shuffle),
and only keys above a share of the total are cut into slices. Each row of a hot key
goes to one slice of its own side and is repeated over the other side's slices, so each
pair still meets exactly once and nothing is dropped. Slices come from a hash of the
row, never from a random number: a task that is run again sends its rows to the same
place.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import require

SKEW = ("auto", "salt", "off")

# A key is hot when it holds more than 1/(SLICES_PER_TASK * shuffle partitions) of the work.
SLICES_PER_TASK = 4


def planned_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate for `df`, the one its own broadcast rule looks at."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:  # no JVM plan at hand, e.g. under Spark Connect
        return None


def is_unfolded(df: DataFrame) -> bool:
    """Whether `df` makes rows out of rows, whose number Catalyst's size estimate leaves out."""
    try:
        text = df._jdf.queryExecution().optimizedPlan().toString()
    except AttributeError:  # as above
        return False
    return re.search(r"^\W*Generate ", text, re.MULTILINE) is not None


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own size check would let it broadcast `df`, and has counted all of its rows."""
    limit = _to_bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    size = planned_bytes(df)
    return size is not None and size <= limit and not is_unfolded(df)


def _sized(left: DataFrame, right: DataFrame, how: str) -> tuple[DataFrame, DataFrame]:
    """Both sides so that none is broadcast because of an estimate that leaves out rows."""
    if not (is_unfolded(left) or is_unfolded(right)):
        return left, right
    if how != "full" and fits_broadcast(right):
        return left, F.broadcast(right)
    if how == "inner" and fits_broadcast(left):
        return F.broadcast(left), right
    return left.hint("merge"), right


def _to_bytes(text: str) -> int:
    text = text.strip().lower().removesuffix("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    if text and text[-1] in units:
        return int(text[:-1]) * units[text[-1]]
    return int(text)


def shuffle_tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def one_cell(value: str) -> Column:
    """Weight of a row that is a single cell.

    It looks at the value on purpose. When a factor is itself an aggregate, counting rows
    would prune the value and need an exchange of its own; with the value in use, the
    counting pass reads the very exchange the join reads, and Spark runs it once.
    """
    return F.when(F.col(value).isNotNull(), 1).otherwise(0)


def hot_keys(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_cells: Column,
    right_cells: Column,
) -> DataFrame:
    """Keys above the share, with the number of slices for each side.

    All loads sum to the total, so fewer keys than SLICES_PER_TASK * shuffle partitions
    can exceed the share, whatever the data. That bound is what makes the result safe to
    broadcast.
    """
    slices = SLICES_PER_TASK * shuffle_tasks(left)
    none = F.lit(0).cast("bigint")
    # One aggregation over both sides, summed before its shuffle; the total reads it again.
    counts = left.select(*on, left_cells.cast("bigint").alias("_cl"), none.alias("_cr")).unionByName(
        right.select(*on, none.alias("_cl"), right_cells.cast("bigint").alias("_cr"))
    )
    # Double: a product of two counts can pass the BIGINT range, and only its size matters.
    load = counts.groupBy(*on).agg(
        F.sum("_cl").cast("double").alias("_cl"), F.sum("_cr").cast("double").alias("_cr")
    )
    load = load.withColumn("_w", F.col("_cl") * F.col("_cr") + F.col("_cl") + F.col("_cr"))
    total = load.agg(F.sum("_w").alias("_total")).scalar()
    want = F.ceil(F.col("_w") * slices / total)
    # Slices in proportion to the sides, which repeats the fewest rows.
    nl_slices = F.greatest(
        F.lit(1).cast("bigint"),
        F.least(
            F.ceil(F.sqrt(want * F.col("_cl") / F.greatest(F.col("_cr"), F.lit(1.0)))),
            F.col("_cl").cast("bigint"),
            want,
        ),
    )
    return (
        load.where(F.col("_w") * slices > total)
        .withColumn("_nl", nl_slices)
        .withColumn(
            "_nr",
            F.greatest(
                F.lit(1).cast("bigint"),
                F.least(F.ceil(want / F.col("_nl")), F.col("_cr").cast("bigint")),
            ),
        )
        .select(*on, "_nl", "_nr", ((F.col("_cl") > 0) & (F.col("_cr") > 0)).alias("_both"))
    )


def deal(df: DataFrame, tasks: int, task: str, number: Column) -> DataFrame:
    """Rows to the partition that `number` names (modulo `tasks`), kept in column `task`.

    The column is the partition number itself. So a join on it and other keys, and sums by
    it and other columns above that join, find their rows in place and need no exchange.
    """
    return df.withColumn(task, F.pmod(number, F.lit(tasks)).cast("int")).repartitionById(tasks, task)


def _spread(df: DataFrame, hot: DataFrame, on, own, other, own_count, other_count, split, task=None):
    one = F.lit(1).cast("bigint")
    zero = F.lit(0).cast("bigint")
    sliced = (
        df.join(F.broadcast(hot), list(on), "left")
        .withColumn(own, F.pmod(F.xxhash64(*split), F.coalesce(own_count, one)))
        .withColumn(other, F.explode(F.sequence(zero, F.coalesce(other_count, one) - 1)))
        .drop("_nl", "_nr")
    )
    # The number is given: adaptive execution would merge slices again by their bytes, which
    # say nothing about the pairs they make.
    if task is None:
        return sliced.repartition(shuffle_tasks(df), *on, *sorted((own, other)))
    return deal(sliced, shuffle_tasks(df), task, F.xxhash64(*on, *sorted((own, other))))


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    left_cells: Column,
    right_cells: Column,
    left_split: Sequence[str],
    right_split: Sequence[str],
    skew: str = "auto",
    task: str | None = None,
) -> DataFrame:
    """Join `left` and `right` on the columns `on` (``inner``, ``left`` or ``full``).

    `left_cells`/`right_cells` give the number of cells in a row (a vector has many);
    `left_split`/`right_split` name the columns that tell the rows of one key apart.
    Other column names must not occur on both sides.

    ``auto`` leaves the join to Catalyst when Spark's size check allows one side to be
    broadcast (then no row is shuffled, and skew has nothing to bite on), and slices hot
    keys otherwise. ``salt`` always slices, ``off`` never does.

    `task` names a further column of the result: the number of the task that makes the row.
    Sums by it and other columns take place in that task, without an exchange. Where one
    side is broadcast, the rows of the other are dealt out by what tells them apart and a
    slice of the key, so that what is summed later meets early. Not for ``full``, whose
    unmatched rows have no place of their own.
    """
    require(how, ("inner", "left", "full") if task is None else ("inner", "left"), "how")
    require(skew, SKEW, "skew")
    on = list(on)
    plain = skew == "off"
    if skew == "auto":
        plain = (how != "full" and fits_broadcast(right)) or (how == "inner" and fits_broadcast(left))
    tasks = shuffle_tasks(left)
    if plain and task is None:
        left, right = _sized(left, right, how)
        return left.join(right, on, "full_outer" if how == "full" else how)
    if plain:
        out = [*on, *(c for c in left.columns if c not in on), *(c for c in right.columns if c not in on), task]
        slices = F.lit(max(1, math.isqrt(SLICES_PER_TASK * tasks)))
        if fits_broadcast(right):
            left = deal(left, tasks, task, F.xxhash64(*left_split, F.pmod(F.xxhash64(*on), slices)))
            joined = left.join(F.broadcast(right), on, how)
        elif how == "inner" and fits_broadcast(left):
            right = deal(right, tasks, task, F.xxhash64(*right_split, F.pmod(F.xxhash64(*on), slices)))
            joined = F.broadcast(left).join(right, on)
        else:
            key = F.xxhash64(*on)
            joined = deal(left, tasks, task, key).join(deal(right, tasks, task, key), [task, *on], how)
        return joined.select(*out)

    # The join implies these filters. Said here, they reach the counting pass too, whose
    # exchanges then equal the join's and are shared with it.
    for key in on:
        left = left.where(F.col(key).isNotNull()) if how == "inner" else left
        right = right.where(F.col(key).isNotNull()) if how != "full" else right
    out = [*on, *(c for c in left.columns if c not in on), *(c for c in right.columns if c not in on)]
    hot = hot_keys(left, right, on, left_cells, right_cells)
    ls = _spread(left, hot, on, "_ls", "_rs", F.col("_nl"), F.col("_nr"), left_split, task)
    rs = _spread(right, hot, on, "_rs", "_ls", F.col("_nr"), F.col("_nl"), right_split, task)
    keys = [*on, "_ls", "_rs"]  # the order in which _spread deals them out
    if task is not None:
        keys, out = [task, *keys], [*out, task]
    if how == "inner":
        # A hot key of one side only has no partner: its rows need not travel.
        ls = ls.where(F.coalesce("_both", F.lit(True))).drop("_both")
        rs = rs.where(F.coalesce("_both", F.lit(True))).drop("_both")
        if is_unfolded(left) or is_unfolded(right):
            ls = ls.hint("merge")
        return ls.join(rs, keys).select(*out)
    ls = ls.withColumnRenamed("_both", "_bl").withColumn("_pl", F.lit(True))
    rs = rs.withColumnRenamed("_both", "_br").withColumn("_pr", F.lit(True))
    joined = ls.join(rs, keys, "full_outer" if how == "full" else "left")
    # A repeated row may miss in an empty slice. Its key is on both sides, so it has met its
    # partners in other slices, and the miss is no result row.
    both = F.coalesce("_bl", "_br", F.lit(False))
    missed = F.col("_pl").isNull() | F.col("_pr").isNull()
    return joined.where(~(both & missed)).select(*out)


def slice_factors(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    *,
    left_cells: Column,
    right_cells: Column,
    left_split: Sequence[str],
    right_split: Sequence[str],
    task: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Both sides as :func:`skew_join` slices them, with the slice in ``_ls`` and ``_rs``, to be stored.

    An inner join on `on`, ``_ls`` and ``_rs`` is the join on `on`. Keys of one side only may
    be left out. `task` names a further column, the number of the task that has the row.
    """
    for key in on:
        left, right = left.where(F.col(key).isNotNull()), right.where(F.col(key).isNotNull())
    hot = hot_keys(left, right, on, left_cells, right_cells)
    ls = _spread(left, hot, on, "_ls", "_rs", F.col("_nl"), F.col("_nr"), left_split, task)
    rs = _spread(right, hot, on, "_rs", "_ls", F.col("_nr"), F.col("_nl"), right_split, task)
    met = F.coalesce("_both", F.lit(True))
    return ls.where(met).drop("_both"), rs.where(met).drop("_both")
