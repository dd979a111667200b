"""Packing token sequences by exact complements, then best fit."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .byte_pieces import byte_pieces
from .common import materialize, slices

#: Tokens of a packed sequence.
LIMIT = 1024

#: Ends each document.
END = 2


class Plan:
    """Which ranks of each length go to which sequences, from the counts of lengths alone.

    Pieces of one length are interchangeable, so a plan is a list of steps ``(length, rank,
    count, sequence, offset)``: the pieces of that length with ranks from ``rank`` on go to
    ``count`` sequences in a row, at ``offset`` in each. There are at most ``limit`` lengths
    and each step uses up a length or a kind of gap, so the plan's size depends on ``limit``
    and not on the number of pieces.
    """

    def __init__(self, counts: dict[int, int], limit: int = LIMIT):
        if any(not 1 <= n <= limit for n in counts):
            raise ValueError(f"lengths must lie in 1..{limit}")
        self.limit = limit
        self.left = np.zeros(limit + 1, np.int64)
        for n, c in counts.items():
            self.left[n] = c
        self.rank = np.zeros(limit + 1, np.int64)
        self.sequences = 0
        self.steps: list[tuple[int, int, int, int, int]] = []
        for n in range(limit, 0, -1):
            self._complete(n)
        self.exact = self.sequences
        self._best_fit()

    def _put(self, n: int, count: int, sequence: int, offset: int) -> None:
        self.steps.append((n, int(self.rank[n]), count, sequence, offset))
        self.rank[n] += count
        self.left[n] -= count

    def _fill(self, parts: list[int]) -> None:
        """As many sequences of these lengths as there are pieces for."""
        need = {n: len(list(same)) for n, same in groupby(parts)}
        count = min(int(self.left[n]) // k for n, k in need.items())
        offset = 0
        for n in parts:
            self._put(n, count, self.sequences, offset)
            offset += n
        self.sequences += count

    def _complete(self, n: int) -> None:
        """Use up pieces of length n with one, two or three others (none longer) that fill the gap."""
        while self.left[n]:
            others = self._complement(n, self.limit - n)
            if others is None:
                return
            self._fill([n, *others])

    def _complement(self, n: int, gap: int) -> list[int] | None:
        """Lengths, longest first, that sum up to ``gap`` and are there beside one piece of n."""
        if not gap:
            return []
        left = self.left.copy()
        left[n] -= 1
        if gap <= n and left[gap]:
            return [gap]
        top = min(n, gap - 1)
        pair = self._pair(left, top, gap)
        if pair:
            return pair
        for a in np.flatnonzero(left[: top + 1])[::-1].tolist():
            if 3 * a < gap:
                return None
            left[a] -= 1
            pair = self._pair(left, min(a, gap - a - 1), gap - a)
            left[a] += 1
            if pair:
                return [a, *pair]
        return None

    @staticmethod
    def _pair(left: np.ndarray, top: int, total: int) -> list[int] | None:
        """Two available lengths up to ``top`` with that sum, the longest first."""
        low = (total + 1) // 2
        if top < low:
            return None
        a = np.arange(low, top + 1)
        both = (left[a] > 0) & (left[total - a] > (2 * a == total))
        at = np.flatnonzero(both)
        return [int(a[at[-1]]), int(total - a[at[-1]])] if len(at) else None

    def _best_fit(self) -> None:
        """The rest by decreasing length, each into the smallest gap that takes it."""
        gaps: list[list[tuple[int, int]]] = [[] for _ in range(self.limit + 1)]  # (sequence, count) by gap
        open_gaps = np.zeros(self.limit + 1, bool)

        def leave(gap: int, sequence: int, count: int) -> None:
            if gap and count:
                gaps[gap].append((sequence, count))
                open_gaps[gap] = True

        for n in range(self.limit, 0, -1):
            while self.left[n]:
                room = np.flatnonzero(open_gaps[n:])
                if len(room):
                    gap = n + int(room[0])
                    sequence, count = gaps[gap].pop()
                    open_gaps[gap] = bool(gaps[gap])
                    used = min(count, int(self.left[n]))
                    self._put(n, used, sequence, self.limit - gap)
                    leave(gap, sequence + used, count - used)
                    leave(gap - n, sequence, used)
                    continue
                fit = self.limit // n
                fit, count = (fit, int(self.left[n]) // fit) if self.left[n] >= fit else (int(self.left[n]), 1)
                for k in range(fit):
                    self._put(n, count, self.sequences, k * n)
                leave(self.limit - fit * n, self.sequences, count)
                self.sequences += count

    def arrays(self) -> tuple[np.ndarray, ...]:
        """The steps as columns, by length and rank."""
        steps = np.array(self.steps, np.int64).reshape(-1, 5)
        return tuple(steps[np.lexsort((steps[:, 1], steps[:, 0]))].T)


def _encoder(path: str, limit: int, end: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, seen = TaskContext.get().partitionId(), np.zeros(limit + 1, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, at = byte_pieces(path).encode(part.column("text"))
                size = np.diff(at) + 1  # with the end
                ids = np.insert(ids.astype("<u4"), at[1:], end)
                at = np.concatenate([[0], np.cumsum(size)])
                count = -(-size // limit)
                doc = np.repeat(np.arange(len(size)), count)
                number = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                first = (size - 1) % limit + 1  # the first piece takes what the others leave
                start = np.where(number, first[doc] + (number - 1) * limit, 0)
                length = np.where(number, limit, first[doc])
                # the rank of a piece among those of its length in this task
                order = np.argsort(length, kind="stable")
                per = np.bincount(length, minlength=limit + 1)
                rank = np.empty(len(length), np.int64)
                rank[order] = np.arange(len(length)) - np.repeat(np.cumsum(per) - per, per)
                rank += seen[length]
                seen += per
                raw = memoryview(ids.tobytes())
                spans = list(zip((4 * (at[doc] + start)).tolist(), (4 * (at[doc] + start + length)).tolist(), strict=True))
                columns = [
                    part.column("key").take(pa.array(doc)),
                    pa.array(number, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array([zlib.crc32(raw[a:b]) for a, b in spans], pa.int64()),
                    pa.array(np.full(len(doc), shard), pa.int32()),
                    pa.array(rank, pa.int64()),
                ]
                names = ["key", "piece", "start", "length", "ids_crc32", "shard", "rank"]
                if keep_ids:
                    columns.append(pa.array([bytes(raw[a:b]) for a, b in spans], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _placer(steps: tuple[np.ndarray, ...], limit: int):
    length, rank, _, sequence, offset = steps
    # one number orders the steps by length and rank: counts of a length stay below 2**50
    keys = (length << 50) + rank

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
            own = column("rank")
            step = np.searchsorted(keys, (column("length") << 50) + own, "right") - 1
            out = {c: batch.column(c) for c in batch.schema.names if c != "rank"}
            out["sequence_id"] = pa.array(sequence[step] + own - rank[step], pa.int64())
            out["offset"] = pa.array(offset[step], pa.int64())
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

    return run


def pack(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT, end: int = END, keep_ids: bool = False
) -> DataFrame:
    """``(key, piece, start, length, ids_crc32, sequence_id, offset)`` of every piece of every row.

    A text's ids, as the library gives them for the whole text, are followed by ``end``. A
    row with more than ``limit`` ids is cut into pieces of ``limit``, of which the first
    takes the remainder; others are one piece. Pieces are laid without gaps into sequences
    of at most ``limit`` ids. ``keep_ids`` adds ``ids``, the piece's ids as little-endian
    unsigned 32-bit integers.

    Only the numbers of pieces by length (at most ``limit`` of them) come to the driver, where
    :class:`Plan` pairs them off. A piece's rank among those of its length, its place in
    its task's output and the counts of the tasks before, finds its place in the plan, so
    no task sees all pieces of a length. Null and empty texts are the end alone; rows with
    the same or no key are packed one by one; other columns are not looked at; an empty
    table has no pieces. The pieces are kept in a table, so that ranks stay as they are if
    executors are lost.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long, shard int, rank long" + (", ids binary" if keep_ids else "")
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    pieces = materialize(rows.mapInArrow(_encoder(tokenizer, limit, end, keep_ids), schema), "pieces")
    counts = pieces.groupBy("shard", "length").agg(F.count("rank").alias("n"))
    plan = Plan({r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}, limit)
    # one row per task and length
    before = (F.sum("n").over(W.partitionBy("length").orderBy("shard")) - F.col("n")).alias("before")
    before = counts.select("shard", "length", before)
    ranked = pieces.join(before, ["shard", "length"])
    columns = ["key", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    ranked = ranked.select(*columns, (F.col("before") + F.col("rank")).alias("rank"))
    types = {"key": kind, "piece": "int", "ids": "binary"}
    out = ", ".join(f"{c} {types.get(c, 'long')}" for c in [*columns, "sequence_id", "offset"])
    return ranked.mapInArrow(_placer(plan.arrays(), limit), out).withColumnRenamed("key", key)
