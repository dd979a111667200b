"""Shared pieces of the corpus operators: scratch tables, and words of Arrow texts in numpy."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.multiply import maybe_wanted, surely_unwanted
from ..plans.scratch import scratch_path

#: Whether files of a query's shuffles are removed as soon as it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Bytes after which an Arrow batch is full; one of 10,000 documents takes tens of MB on both sides.
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Bytes of text that a task works on at once (a longer text is worked on by itself).
SLICE_BYTES = 4 << 20

#: ASCII white space, the separators of plain words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Bytes inside plain words.
PLAIN = ~SPACE

#: Bytes of words made of ASCII letters and digits and of anything beyond ASCII.
ALNUM = np.ones(256, bool)
ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False

#: Lower-cases A-Z and nothing else.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

#: The plain words of a text, as a Java and DuckDB pattern.
WORD = r"[^\x20\x09-\x0D]+"

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.RandomState(7).randint(0, 1 << 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def materialize(df: DataFrame, name: str, shuffles: bool = True, conf: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with a copy that outlives executors, and gives the planner a true size.
    Without ``shuffles`` the files of the shuffles behind ``df`` go as soon as it is written,
    not when the driver next collects its garbage. Arrow batches are full at ``SLICE_BYTES``.
    ``conf`` holds for this write alone.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    own = {_BATCH: str(SLICE_BYTES)} | ({} if shuffles else {_CLEANUP: "true"}) | (conf or {})
    before = {k: spark.conf.get(k) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def without(rows: DataFrame, gone: DataFrame, key: str = "doc_id") -> DataFrame:
    """``rows`` whose ``key`` isn't in ``gone`` (``key``); a null key isn't in any.

    A bitmap of 8 MiB, whatever the size of ``gone``, lets most rows stay where they are; only
    those that share a bit with a key of ``gone`` are shuffled, to be told apart exactly.
    """
    own = fresh(rows, "_gone")
    gone = materialize(gone.select(F.col(key).alias(own)), "gone", shuffles=False)
    placed = rows.withColumn(own, F.col(key).cast(gone.schema[own].dataType))
    stay = surely_unwanted(placed, gone, [own])
    told = maybe_wanted(placed, gone, [own]).join(gone, own, "left_anti")
    return stay.select(*rows.columns).unionAll(told.select(*rows.columns))


def n_words(text: Column) -> Column:
    """Number of plain words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_{uuid.uuid4().hex[:6]}"
    return name


def string_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column, end to end, and the n+1 offsets into them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds at most ``limit`` bytes of ``column``, or one row."""
    _, at = string_buffers(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(at, at[start] + limit, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


class Words:
    """The words of many texts laid end to end.

    ``start``/``end`` are byte positions, ``of`` has for each text the number of its first
    word (n+1 entries). ``data`` holds the bytes (lower-cased if asked). ``cut`` marks bytes
    before which a word ends in any case.
    """

    def __init__(self, data: np.ndarray, at: np.ndarray, inside: np.ndarray, lower: bool = False, cut: np.ndarray | None = None):
        self.data = LOWER[data] if lower else data
        mask = inside[self.data]
        n = len(data)
        edge = np.zeros(n + 1, bool)
        if cut is not None:
            edge[:-1] = cut
        edge[at] = True
        before = np.zeros(n, bool)
        before[1:] = mask[:-1]
        after = np.zeros(n, bool)
        after[:-1] = mask[1:]
        self.start = np.flatnonzero(mask & (~before | edge[:-1]))
        self.end = np.flatnonzero(mask & (~after | edge[1:])) + 1
        self.of = np.searchsorted(self.start, at)
        self.mask = mask

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self):
            return np.zeros(0, np.uint64)
        own = self.data[self.mask]
        lens = self.end - self.start
        first = np.cumsum(lens) - lens
        within = np.arange(len(own)) - np.repeat(first, lens)
        power = np.full(int(lens.max()), _ODD)
        power[0] = 1
        power = np.multiply.accumulate(power)
        return mix(np.add.reduceat(_BYTE[own] * power[within], first) + lens.astype(np.uint64))

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words with one space after each, and where each starts and ends in that."""
        lens = self.end - self.start
        own = self.data[self.mask]
        out = np.full(len(own) + len(lens), 0x20, np.uint8)
        out[np.arange(len(own)) + np.repeat(np.arange(len(lens)), lens)] = own
        start = np.cumsum(lens) - lens + np.arange(len(lens))
        return out, start, start + lens


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (the finaliser of splitmix64), one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(word: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive words, n-k+1 of them."""
    n = len(word) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= _ODD
        out += word[j : j + n]
    return mix(out)


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` consecutive values, n-w+1 of them."""
    n = len(values) - w + 1
    if n <= 0:
        return values[:0]
    span, out = 1, values
    while span * 2 <= w:
        out = np.minimum(out[: len(out) - span], out[span:])
        span *= 2
    return np.minimum(out[:n], out[w - span : w - span + n])


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``start[i], start[i]+1, ...`` (``count[i]`` of them) for every i, end to end."""
    total = int(count.sum())
    first = np.cumsum(count) - count
    return np.repeat(start - first, count) + np.arange(total)


def covered(n: int, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in any of the spans."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + length, -1)
    return np.cumsum(change[:n]) > 0
