"""Text and Parquet writers for matrices.

``format_*`` gives a DataFrame with the text in column ``value``; ``write_*`` stores it.
Formats (fixed, so that files can be exchanged):

* cells: ``i TAB j TAB v``, or with ``style="pair"``: ``i j TAB v``
* row vector: ``i TAB c v c v `` with a blank after every number
* outer record: ``n TAB`` A's n pairs, then B's pairs, in the same form
* scaled row: ``i p TAB`` B's pairs, in the same form

Writers leave the number of files to Spark's partitioning. ``sort=True`` orders the
output over all files with range partitions.
"""

from __future__ import annotations

import contextlib
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vec_text
from ..operators.layout import sorted_by, split_halves
from ..operators.skew import SLICES_PER_TASK, deal, shuffle_tasks
from ..schema import require

STYLES = ("tab", "pair")

_TAB = "\t"

# Whether files of a query's shuffles are removed as soon as it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_go(spark: SparkSession):
    """What is written meanwhile leaves no files of its shuffles until the driver collects its garbage."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def _text(name: str):
    return F.col(name).cast("string")


def format_coo(df: DataFrame, style: str = "tab") -> DataFrame:
    """Cell lines from the first three columns of `df`."""
    require(style, STYLES, "style")
    row, col, val = (_text(c) for c in df.columns[:3])
    between = F.lit(_TAB if style == "tab" else " ")
    return df.select(F.concat(row, between, col, F.lit(_TAB), val).alias("value"))


def format_row_vectors(df: DataFrame, row: str = "i", vec: str = "vec") -> DataFrame:
    return df.select(F.concat(_text(row), F.lit(_TAB), vec_text(vec)).alias("value"))


def format_outer_records(df: DataFrame, *keep: str) -> DataFrame:
    """Lines from `av` and `bv`; columns named in `keep` stay beside them."""
    n = F.size("av").cast("string")
    line = F.concat(n, F.lit(_TAB), vec_text("av"), vec_text("bv"))
    return df.select(*keep, line.alias("value"))


def format_scaled_rows(df: DataFrame) -> DataFrame:
    line = F.concat(_text("i"), F.lit(" "), _text("p"), F.lit(_TAB), vec_text("bv"))
    return df.select(line.alias("value"))


def _save(lines: DataFrame, path: str, mode: str, line_sep: str) -> None:
    lines.write.mode(mode).option("lineSep", line_sep).text(path)


def write_coo(
    df: DataFrame,
    path: str,
    *,
    style: str = "tab",
    sort: bool = False,
    mode: str = "errorifexists",
    line_sep: str = "\n",
) -> None:
    if sort:
        df = sorted_by(df, *df.columns[:2])
    _save(format_coo(df, style), path, mode, line_sep)


def write_row_vectors(
    df: DataFrame,
    path: str,
    row: str = "i",
    *,
    sort: bool = False,
    mode: str = "errorifexists",
    line_sep: str = "\n",
) -> None:
    if sort:
        df = sorted_by(df, *(c for c in (row, "seg") if c in df.columns))
    _save(format_row_vectors(df, row), path, mode, line_sep)


def write_outer_records(
    df: DataFrame,
    path: str,
    *,
    acol: int | None = None,
    mode: str = "errorifexists",
    line_sep: str = "\n",
) -> None:
    """Outer records as text; with `acol`, in folders ``half=A`` and ``half=B`` of `path`."""
    if acol is None:
        _save(format_outer_records(df), path, mode, line_sep)
        return
    lines = format_outer_records(split_halves(df, acol), "half")
    lines.write.mode(mode).option("lineSep", line_sep).partitionBy("half").text(path)


def write_scaled_rows(
    df: DataFrame, path: str, *, mode: str = "errorifexists", line_sep: str = "\n"
) -> None:
    _save(format_scaled_rows(df), path, mode, line_sep)


def write_partials(
    df: DataFrame, path: str, buckets: int, *, mode: str = "errorifexists", replace: str = "all"
) -> None:
    """Partial products as Parquet, one folder per bucket of k.

    With ``mode="overwrite"``, ``replace="touched"`` replaces the folders that `df` has rows
    for and leaves the others as they are.

    The rebalance hint gathers a bucket's rows before the write, so tasks do not each open
    a file per bucket, and splits a bucket that is too large for one task.
    """
    _save_buckets(df.select("k", "i", "j", "p", bucket_of(buckets)).hint("rebalance", "k_bucket"), path, mode, replace)


def bucket_of(buckets: int) -> Column:
    return F.pmod("k", F.lit(int(buckets))).alias("k_bucket")


def _save_buckets(bucketed: DataFrame, path: str, mode: str, replace: str) -> None:
    writer = bucketed.write.mode(mode).partitionBy("k_bucket")
    with shuffles_go(bucketed.sparkSession):
        writer.option("partitionOverwriteMode", "dynamic" if replace == "touched" else "static").parquet(path)


def write_summed_partials(df: DataFrame, path: str, buckets: int) -> None:
    """Sums of partial products by (k, i, j) in place of the folders that `df` has rows for.

    They are dealt out once, to tasks that each have rows of one bucket, and summed and
    written there. A bucket is several tasks and so is a hot k in it.
    """
    slices = max(1, math.ceil(SLICES_PER_TASK * shuffle_tasks(df) / buckets))
    place = F.pmod("k", F.lit(int(buckets))) * slices + F.pmod(F.xxhash64("k", "i"), F.lit(slices))
    dealt = deal(df, int(buckets) * slices, "_task", place)
    summed = dealt.groupBy("_task", "k", "i", "j").agg(F.sum("p").alias("p"))
    _save_buckets(summed.select("k", "i", "j", "p", bucket_of(buckets)), path, "overwrite", "touched")
