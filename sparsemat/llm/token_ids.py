"""Token ids in binary files: Re-Pair grammars per block, with random access."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize, shuffle_tasks, slices
from .tokenizer import chunk_ids

#: Ids of a block; a document with more is a block by itself.
BLOCK_IDS = 1 << 19

#: Bytes of text that are encoded at once; about 40 times as many are in use meanwhile.
TEXT_BYTES = 1 << 20

#: Rounds of a block's grammar, rules a round adds at most, and how often a pair must occur.
ROUNDS, ROUND_RULES, LEAST = 6, 2048, 12

#: Ends each document.
END = 1

_SLOTS = 1 << 20


def _slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a * np.uint32(0x9E3779B1) + b * np.uint32(0x85EBCA77)) >> np.uint32(12)).astype(np.int32)


def compress(ids: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """``(rules, sequence)``: rule r stands for the pair ``rules[r]`` and is written ``base + r``.

    Re-Pair in rounds: the most frequent pairs of neighbours are all replaced from the left,
    then pairs are counted again, nonterminals included. Ids must be below ``base``.
    """
    seq = ids.astype(np.uint32)
    rules: list[np.ndarray] = []
    for _ in range(ROUNDS):
        if len(seq) < 2:
            break
        slot = _slot(seq[:-1], seq[1:])
        counts = np.bincount(slot, minlength=_SLOTS)
        top = np.flatnonzero(counts >= LEAST)
        if len(top) > ROUND_RULES:
            top = top[np.argsort(-counts[top], kind="stable")[:ROUND_RULES]]
        if not len(top):
            break
        rule = np.full(_SLOTS, -1, np.int16)
        rule[top] = np.arange(len(top))
        own = rule[slot]
        at = np.flatnonzero(own >= 0)
        seen = np.zeros(len(top), np.int64)
        seen[own[at]] = at  # one pair stands for its slot
        pair = np.stack([seq[seen], seq[seen + 1]], 1)
        at = at[(pair[own[at], 0] == seq[at]) & (pair[own[at], 1] == seq[at + 1])]
        # overlapping places: of a run of neighbours every second one
        run = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))) % 2 == 0]
        used = np.bincount(own[at], minlength=len(top))
        good = used >= LEAST // 2
        at = at[good[own[at]]]
        if not len(at):
            break
        name = np.cumsum(good) - 1 + base + sum(map(len, rules))
        rules.append(pair[good])
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq = seq.copy()
        seq[at] = name[own[at]]
        seq = seq[keep]
    return (np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)).astype(np.uint32), seq


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """How many ids each rule stands for."""
    out = np.ones(len(rules), np.int64)
    for r, (a, b) in enumerate(rules.tolist()):
        out[r] = (out[a - base] if a >= base else 1) + (out[b - base] if b >= base else 1)
    return out


def expand(seq: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids that ``seq`` stands for."""
    seq = seq.astype(np.uint32)
    while len(seq) and len(at := np.flatnonzero(seq >= base)):
        width = np.ones(len(seq), np.int64)
        width[at] = 2
        place = np.cumsum(width) - width
        out = np.empty(int(place[-1] + width[-1]), np.uint32)
        out[place] = seq
        pair = rules[seq[at] - base]
        out[place[at]], out[place[at] + 1] = pair[:, 0], pair[:, 1]
        seq = out
    return seq


#: One row of a file: documents ``n_docs`` with ``ends`` (int64, ids up to each one's end),
#: ``rules`` and ``sequence`` (uint16 if that is wide enough, else uint32) and, for random
#: access, ``lengths`` (uint32, ids that each rule stands for). All little-endian.
BLOCK = "shard long, block long, n_docs long, n_ids long, base long, width int, doc_ids array<long>, ends binary, rules binary, lengths binary, sequence binary"


def _block(shard: int, block: int, docs: list, parts: list[np.ndarray], base: int) -> pa.RecordBatch:
    ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    rules, seq = compress(ids, base)
    kind = "<u2" if base + len(rules) <= 1 << 16 else "<u4"
    row = {
        "shard": shard,
        "block": block,
        "n_docs": len(docs),
        "n_ids": len(ids),
        "base": base,
        "width": int(kind[-1]),
        "doc_ids": docs,
        "ends": np.cumsum([len(p) for p in parts]).astype("<i8").tobytes(),
        "rules": rules.astype(kind).tobytes(),
        "lengths": expansion_lengths(rules, base).astype("<u4").tobytes(),
        "sequence": seq.astype(kind).tobytes(),
    }
    kinds = [pa.int64()] * 5 + [pa.int32(), pa.list_(pa.int64())] + [pa.binary()] * 4
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds, strict=True)], list(row))


def _encoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, size = TaskContext.get().partitionId(), 0, 0
        docs: list = []
        parts: list[np.ndarray] = []
        base = chunk_ids(path).size
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                flat, at = chunk_ids(path).encode(part.column("text"))
                for d, doc in enumerate(part.column("doc_id").to_pylist()):
                    own = np.append(flat[at[d] : at[d + 1]], np.uint32(END))
                    if docs and size + len(own) > BLOCK_IDS:
                        yield _block(shard, block, docs, parts, base)
                        block, size, docs, parts = block + 1, 0, [], []
                    docs.append(doc)
                    parts.append(own)
                    size += len(own)
        if docs:
            yield _block(shard, block, docs, parts, base)

    return run


def write_ids(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode whole texts and write them by ascending id; returns the blocks as read back.

    Ids are dealt into ranges, one file (shard) each; the shards and the blocks in a shard
    follow the order of ids, null first. A null text has no ids but the end. Rows with the
    same id stand by text. The files are Parquet in the cluster's shared folder, committed
    task by task, so a lost task is written again as it was.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.repartitionByRange(shuffle_tasks(docs.sparkSession), F.col("doc_id").asc_nulls_first())
    rows = rows.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    return materialize(rows.mapInArrow(_encoder(tokenizer), BLOCK), "token-ids")


def _parts(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kind = f"<u{row['width']}"
    rules = np.frombuffer(row["rules"], kind).reshape(-1, 2)
    return np.frombuffer(row["ends"], "<i8"), rules, np.frombuffer(row["sequence"], kind)


def read_block(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a block, and the place after each document's last one."""
    ends, rules, seq = _parts(row)
    return expand(seq, rules.astype(np.uint32), row["base"]), ends


def read_range(row: dict, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a block; only symbols that reach into the range are expanded."""
    _, rules, seq = _parts(row)
    lengths = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
    width = np.ones(len(seq), np.int64)
    nonterminal = seq >= row["base"]
    width[nonterminal] = lengths[seq[nonterminal].astype(np.int64) - row["base"]]
    end = np.cumsum(width)
    stop = min(stop, int(end[-1]) if len(end) else 0)
    if start >= stop:
        return np.zeros(0, np.uint32)
    a, b = int(np.searchsorted(end, start, "right")), int(np.searchsorted(end, stop))
    skip = start - int(end[a] - width[a])
    return expand(seq[a : b + 1], rules.astype(np.uint32), row["base"])[skip : skip + stop - start]


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids, ends = read_block(row)
            raw = memoryview(ids.astype("<u4").tobytes())
            start = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(start.tolist(), ends.tolist(), strict=True)]
            n = len(ends)
            columns = [[row["shard"]] * n, [row["block"]] * n, row["doc_ids"], start, ends - start, crc]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], _DIGEST)


_DIGEST = ["shard", "block", "doc_id", "at", "n_tokens", "ids_crc32"]


def token_files(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every row, from the files that were written.

    ``start`` counts the ids of all rows before: those of earlier shards, of earlier blocks
    of the shard, and of the block.
    """
    blocks = write_ids(docs, tokenizer, key, text)
    sizes = blocks.select("shard", "block", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n"))  # as many rows as files
    shards = shards.select("shard", (F.sum("n").over(W.orderBy("shard")) - F.col("n")).alias("before"))
    inside = F.sum("n_ids").over(W.partitionBy("shard").orderBy("block")) - F.col("n_ids")
    starts = sizes.select("shard", "block", inside.alias("inside")).join(shards, "shard")
    rows = blocks.mapInArrow(_digest, ", ".join(f"{c} long" for c in _DIGEST)).join(starts, ["shard", "block"])
    return rows.select("doc_id", (F.col("before") + F.col("inside") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
