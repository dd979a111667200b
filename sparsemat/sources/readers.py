"""Text and Parquet readers for matrices.

``parse_*`` turns a DataFrame of lines (column ``value``, as ``spark.read.text`` gives it)
into a layout; ``read_*`` opens files, any number of paths at once. Lines are read by
Spark's line reader, so CRLF files work.

A line that does not fit the layout fails the query under ``mode="FAILFAST"`` (default),
is left out under ``"DROPMALFORMED"``, and under ``"PERMISSIVE"`` yields nulls with the
line kept in the column `corrupt`. :class:`LineCounts` counts lines and what is wrong with
them while they are parsed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import assert_rows, coo_schema, require

MODES = ("FAILFAST", "DROPMALFORMED", "PERMISSIVE")
CORRUPT = "_corrupt_record"

_BLANKS = " \t\r\n\f\x0b"


class MalformedLines(ValueError):
    """More lines than allowed did not fit the layout."""


class LineCounts:
    """Counts of lines, taken in passing by the action that parses them.

    Give one to a parser as `counts`, run an action on the result, then look: no second pass
    over the lines takes place. Each malformed line counts under its first `reason`. A task
    that is run again counts once.
    """

    def __init__(self) -> None:
        self.observation = Observation()

    def attach(self, parsed: DataFrame, ok: Column, reasons: dict[str, Column]) -> DataFrame:
        found = F.lit(None).cast("string")
        for reason, holds in reversed(reasons.items()):
            found = F.when(F.coalesce(holds, F.lit(True)), F.lit(reason)).otherwise(found)
        per = [F.count_if(~ok & found.eqNullSafe(F.lit(reason))).alias(reason) for reason in reasons]
        total = F.count(F.lit(1)).alias("lines"), F.count_if(~ok).alias("malformed")
        return parsed.observe(self.observation, *total, *per)

    def get(self) -> dict[str, int]:
        """``lines``, ``malformed`` and one count per reason; waits for the first action's end."""
        return dict(self.observation.get)

    def check(self, max_malformed: int | None = None, max_share: float | None = None) -> dict[str, int]:
        """The counts, or :class:`MalformedLines` if more lines were malformed than allowed."""
        found = self.get()
        bad, lines = found["malformed"], found["lines"]
        if (max_malformed is not None and bad > max_malformed) or (max_share is not None and bad > max_share * lines):
            why = ", ".join(f"{name}: {n}" for name, n in found.items() if name not in ("lines", "malformed") and n)
            raise MalformedLines(f"{bad} of {lines} lines are malformed ({why})")
        return found


def _paths(path: str | Sequence[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One or several text files or folders as lines."""
    return spark.read.text(_paths(path))


def read_coo(
    spark: SparkSession,
    path: str | Sequence[str],
    names: tuple[str, str] = ("i", "k"),
    *,
    sep: str = "\t",
    mode: str = "FAILFAST",
    corrupt: str = CORRUPT,
) -> DataFrame:
    """Strict reader: three integers per line, separated by `sep` exactly."""
    require(mode, MODES, "mode")
    schema = coo_schema(*names)
    reader = spark.read.option("sep", sep).option("mode", mode)
    if mode == "PERMISSIVE":
        schema = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    cells = reader.schema(schema).csv(_paths(path))
    if mode == "PERMISSIVE":
        return cells
    # The csv reader takes an empty field for a null, which a cell cannot have.
    whole = F.col(names[0]).isNotNull() & F.col(names[1]).isNotNull() & F.col("v").isNotNull()
    if mode == "DROPMALFORMED":
        return cells.where(whole)
    found = F.concat_ws(sep, *(F.coalesce(F.col(n).cast("string"), F.lit("")) for n in cells.columns))
    return assert_rows(cells, whole, F.concat(F.lit("malformed line: "), found))


def _tokens(line: Column) -> Column:
    return F.split(F.btrim(line, F.lit(_BLANKS)), r"\s+")


def _number(token: Column) -> Column:
    return token.try_cast("bigint")


def _by_mode(
    parsed: DataFrame,
    ok: Column,
    keep: Sequence[str],
    mode: str,
    corrupt: str,
    counts: LineCounts | None,
    reasons: dict[str, Column],
) -> DataFrame:
    """Apply the malformed-line mode; `parsed` still has ``value`` beside the columns `keep`."""
    require(mode, MODES, "mode")
    if counts is not None:
        parsed = counts.attach(parsed, ok, reasons)
    if mode == "PERMISSIVE":
        columns = [F.when(ok, F.col(c)).alias(c) for c in keep]
        return parsed.select(*columns, F.when(~ok, F.col("value")).alias(corrupt))
    if mode == "DROPMALFORMED":
        return parsed.where(ok).select(*keep)
    return assert_rows(parsed, ok, F.concat(F.lit("malformed line: "), F.col("value"))).select(*keep)


def parse_coo(
    lines: DataFrame,
    names: tuple[str, str] = ("i", "k"),
    *,
    mode: str = "FAILFAST",
    corrupt: str = CORRUPT,
    counts: LineCounts | None = None,
) -> DataFrame:
    """Lenient reader: three integers apart by any blanks; what follows them is ignored."""
    columns = [*names, "v"]
    parsed = _parse_once(
        lines,
        lambda t: [
            *(_number(F.get(t, F.lit(at))).alias(c) for at, c in enumerate(columns)),
            F.size(t).alias("_size"),
        ],
    )
    ok = F.lit(True)
    for c in columns:
        ok = ok & F.col(c).isNotNull()
    reasons = {"too_short": F.col("_size") < len(columns), "not_a_number": F.lit(True)}
    return _by_mode(parsed, ok, columns, mode, corrupt, counts, reasons)


def _pairs(tokens: Column, skip: Column, count: Column) -> Column:
    """Vector from `count` pairs of number tokens after the first `skip` tokens."""
    zero = F.lit(0).cast("bigint")
    places = F.when(count > 0, F.sequence(zero, count - 1)).otherwise(F.array().cast("array<bigint>"))

    def pair(q: Column) -> Column:
        at = (q * 2 + skip).cast("int")
        return F.struct(_number(F.get(tokens, at)).alias("x"), _number(F.get(tokens, at + 1)).alias("v"))

    return F.transform(places, pair)


def _whole(vec: str) -> Column:
    return F.forall(vec, lambda e: e["x"].isNotNull() & e["v"].isNotNull())


def _parse_once(lines: DataFrame, fields) -> DataFrame:
    """Columns made from a line's tokens by `fields`, beside ``value``.

    Splitting and converting are the cost of a text job. The generator makes them a step
    that filters and projections further up read from instead of repeating it.
    """
    tokens = F.array(_tokens(F.col("value")))
    return lines.select("value", F.inline(F.transform(tokens, lambda t: F.struct(*fields(t)))))


def _parse_vectors(lines, heads, vec, mode, corrupt, counts):
    skip = F.lit(len(heads)).cast("bigint")

    def fields(t):
        rest = F.size(t).cast("bigint") - skip
        return [
            *(_number(F.get(t, F.lit(at))).alias(name) for at, name in enumerate(heads)),
            _pairs(t, skip, F.floor(rest / 2)).alias(vec),
            (rest % 2 == 0).alias("_ok"),
        ]

    head = F.lit(True)
    for name in heads:
        head = head & F.col(name).isNotNull()
    ok = F.col("_ok") & _whole(vec) & head
    reasons = {"head": ~head, "unpaired": ~F.col("_ok"), "not_a_number": F.lit(True)}
    return _by_mode(_parse_once(lines, fields), ok, [*heads, vec], mode, corrupt, counts, reasons)


def parse_row_vectors(
    lines: DataFrame,
    row: str = "i",
    vec: str = "vec",
    *,
    mode: str = "FAILFAST",
    corrupt: str = CORRUPT,
    counts: LineCounts | None = None,
) -> DataFrame:
    """``row [col val]...`` to ``(row, vec)``; a row number alone is an empty vector."""
    return _parse_vectors(lines, [row], vec, mode, corrupt, counts)


def parse_scaled_rows(
    lines: DataFrame, *, mode: str = "FAILFAST", corrupt: str = CORRUPT, counts: LineCounts | None = None
) -> DataFrame:
    """``i p [j v]...`` to ``(i, p, bv)``."""
    return _parse_vectors(lines, ["i", "p"], "bv", mode, corrupt, counts)


def parse_outer_records(
    lines: DataFrame, *, mode: str = "FAILFAST", corrupt: str = CORRUPT, counts: LineCounts | None = None
) -> DataFrame:
    """``n [A column: n pairs] [B row: the rest]`` to ``(n, av, bv)``."""
    one = F.lit(1).cast("bigint")
    none = F.lit(0).cast("bigint")

    def fields(t):
        n = _number(F.get(t, F.lit(0)))
        pairs = F.floor((F.size(t) - one) / 2)
        # Kept within the line, so that a wrong n reaches the mode check.
        first = F.greatest(none, F.least(F.coalesce(n, none), pairs))
        return [
            n.alias("n"),
            _pairs(t, one, first).alias("av"),
            _pairs(t, first * 2 + 1, pairs - first).alias("bv"),
            ((F.size(t) % 2 == 1) & (n == first)).alias("_ok"),
        ]

    ok = F.coalesce("_ok", F.lit(False)) & _whole("av") & _whole("bv")
    reasons = {"head": F.col("n").isNull(), "count": ~F.col("_ok"), "not_a_number": F.lit(True)}
    return _by_mode(_parse_once(lines, fields), ok, ["n", "av", "bv"], mode, corrupt, counts, reasons)


def read_row_vectors(spark: SparkSession, path: str | Sequence[str], row: str = "i", **options) -> DataFrame:
    return parse_row_vectors(read_lines(spark, path), row, **options)


def read_outer_records(spark: SparkSession, path: str | Sequence[str], **options) -> DataFrame:
    return parse_outer_records(read_lines(spark, path), **options)


def read_scaled_rows(spark: SparkSession, path: str | Sequence[str], **options) -> DataFrame:
    return parse_scaled_rows(read_lines(spark, path), **options)


def read_partials(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Partial products ``(k, i, j, p)`` from the folder `write_partials` made."""
    return spark.read.parquet(*_paths(path)).select("k", "i", "j", "p")
