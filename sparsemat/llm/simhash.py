"""SimHash near-duplicates, linked through the anchors of a covering code."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PLAIN, Words, materialize, ranges, slices, string_buffers, without
from .components import components

#: Fingerprints that differ in at most so many of their 64 bits are linked.
MAX_BITS = 3

#: Members of an anchor that one task compares with each other; more are compared in blocks.
CELL = 2048

#: Up to this size a cell's links are given pair by pair, beyond it as a spanning forest.
_SMALL = 16

#: Shingles whose bits are counted in 16-bit lanes before these could overflow.
_LANE = 60_000


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """``(key, fp)``: the 64-bit SimHash of each text as a signed long.

    Words are what ASCII white space separates, A-Z lower-cased; a shingle is ``shingle``
    words joined by spaces, repeats included, the whole sequence if there are fewer words.
    A bit is set if it is set in over half of the shingles' XXH64. No words (null, empty,
    only white space) give 0. Keys may be null or repeated; each row gives one row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                fp = _simhash(*string_buffers(part.column("text")), shingle, seed)
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(fp.view(np.int64))], ["key", "fp"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "key long, fp long")


def _simhash(data: np.ndarray, at: np.ndarray, shingle: int, seed: int) -> np.ndarray:
    words = Words(data, at, PLAIN, lower=True)
    joined, start, end = words.joined()
    count = np.diff(words.of)
    grams = np.where(count >= shingle, count - shingle + 1, np.minimum(count, 1))
    first = ranges(words.of[:-1], grams)
    last = first + np.repeat(np.minimum(count, shingle) - 1, grams)
    blob, digest = joined.tobytes(), xxhash.xxh64_intdigest
    h = np.fromiter(
        (digest(blob[a:b], seed) for a, b in zip(start[first].tolist(), end[last].tolist(), strict=True)),
        np.uint64,
        len(first),
    )
    # each text's hashes in pieces that a 16-bit lane can count
    pieces = -(-grams // _LANE)
    doc = np.repeat(np.arange(len(grams)), pieces)
    offset = ranges(np.zeros(len(grams), np.int64), pieces) * _LANE
    cut = (np.cumsum(grams) - grams)[doc] + offset
    out = np.zeros(len(grams), np.uint64)
    if not len(cut):
        return out
    one, lane = np.uint64(0x0001000100010001), np.uint64(0xFFFF)
    for b in range(16):
        sums = np.add.reduceat((h >> np.uint64(b)) & one, cut)
        for k in range(4):
            ones = np.bincount(doc, ((sums >> np.uint64(16 * k)) & lane).astype(np.float64), len(grams))
            out |= np.where(2 * ones > grams, np.uint64(1) << np.uint64(b + 16 * k), np.uint64(0))
    return out


def _pair_masks() -> np.ndarray:
    """For each syndrome of the [31,26] Hamming code, the 15 pairs of bits that lead to other code words."""
    table = np.zeros((32, 15), np.uint64)
    for s in range(1, 32):
        pairs = [(j, s ^ j) for j in range(1, 32) if j != s and j < s ^ j]
        table[s] = [(1 << (i - 1)) | (1 << (j - 1)) for i, j in pairs]
    return table


_PAIRS = _pair_masks()
_CHECKS = [np.uint64(sum(1 << (p - 1) for p in range(1, 32) if p >> t & 1)) for t in range(5)]


def anchors(fp: np.ndarray) -> np.ndarray:
    """The 34 anchors (some may repeat) of each fingerprint.

    Of two fingerprints at most 3 bits apart, one 32-bit half differs in at most one bit.
    The code for a half is the perfect [31,26] Hamming code (covering radius 1) beside one
    free bit. A fingerprint goes to every code word within radius 1 + threshold 1 of each
    half: its own, the 15 others at distance 2, and its own with the free bit flipped. So
    the nearest anchor of either partner holds both.
    """
    out = []
    for tag, half in enumerate((fp & np.uint64(0xFFFFFFFF), fp >> np.uint64(32))):
        free, word = half & np.uint64(1 << 31), half & np.uint64((1 << 31) - 1)
        syndrome = np.zeros(len(fp), np.int64)
        for t, check in enumerate(_CHECKS):
            syndrome |= (np.bitwise_count(word & check) & 1).astype(np.int64) << t
        own = np.where(syndrome > 0, word ^ (np.uint64(1) << np.maximum(syndrome - 1, 0).astype(np.uint64)), word)
        away = np.where((syndrome > 0)[:, None], word[:, None] ^ _PAIRS[syndrome], own[:, None])
        cells = np.concatenate([own[:, None] | free[:, None], (own | (free ^ np.uint64(1 << 31)))[:, None], away | free[:, None]], 1)
        out.append(cells | np.uint64(tag << 32))
    return np.concatenate(out, 1).view(np.int64)


def _to_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column("fp").to_numpy(zero_copy_only=False)
        cells = np.sort(anchors(fp.view(np.uint64)), 1)
        once = np.ones(cells.shape, bool)
        once[:, 1:] = cells[:, 1:] != cells[:, :-1]
        row = np.nonzero(once)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells[once]), pa.array(fp[row]), batch.column("node").take(pa.array(row))], ["cell", "fp", "node"]
        )


def _compare(limit: int | None):
    """Links within each cell of a stream sorted by cell; cells over ``limit`` pass through for later."""

    def links(cell: np.ndarray, fp: np.ndarray, node: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        size = np.diff(np.r_[start, len(cell)])
        out = []
        small = np.repeat(size <= _SMALL, size)
        for step in range(1, min(_SMALL, int(size.max()))):
            near = (cell[step:] == cell[:-step]) & small[step:] & (np.bitwise_count(fp[step:] ^ fp[:-step]) <= MAX_BITS)
            out.append((node[:-step][near], node[step:][near]))
        for s, n in zip(start[size > _SMALL].tolist(), size[size > _SMALL].tolist(), strict=True):
            out.append(_forest(fp[s : s + n], node[s : s + n]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)]
        large = None  # the cell whose members pass through

        def emit(a, b, cell):
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(cell, pa.int64())], ["a", "b", "cell"])

        def passed(cell, fp, node):
            return emit(node, fp.view(np.int64), cell)

        def done(columns) -> Iterator[pa.RecordBatch]:
            cell, fp, node = columns
            if not len(cell):
                return
            start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            size = np.repeat(np.diff(np.r_[start, len(cell)]), np.diff(np.r_[start, len(cell)]))
            if limit and size.max() > limit:
                hot = size > limit
                yield passed(cell[hot], fp[hot], node[hot])
                cell, fp, node = cell[~hot], fp[~hot], node[~hot]
            if len(cell):
                for a, b in links(cell, fp, node):
                    if len(a):
                        yield emit(a, b, np.full(len(a), None, object))

        for batch in batches:
            if not batch.num_rows:
                continue
            new = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "fp", "node")]
            new[1] = new[1].view(np.uint64)
            kept = [np.concatenate(x) for x in zip(kept, new, strict=True)]
            if large is not None:
                same = kept[0] == large
                if same.any():
                    yield passed(*(x[same] for x in kept))
                    kept = [x[~same] for x in kept]
                if not len(kept[0]):
                    continue
                large = None
            open_from = int(np.searchsorted(kept[0], kept[0][-1]))
            yield from done([x[:open_from] for x in kept])
            kept = [x[open_from:] for x in kept]
            if limit and len(kept[0]) > limit:
                large = kept[0][0]
                yield passed(*kept)
                kept = [x[:0] for x in kept]
        yield from done(kept)

    return run


def _forest(fp: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among ``fp``."""
    n = len(fp)
    near = np.empty((n, n), bool)
    for i in range(0, n, 256):
        near[i : i + 256] = np.bitwise_count(fp[i : i + 256, None] ^ fp[None, :]) <= MAX_BITS
    left = near.sum(1) > 1
    a, b = [], []
    for first in range(n):
        if not left[first]:
            continue
        left[first] = False
        front = np.array([first])
        while len(front):
            front = np.flatnonzero(near[front].any(0) & left)
            left[front] = False
            a.append(np.full(len(front), node[first]))
            b.append(node[front])
    return (np.concatenate(a), np.concatenate(b)) if a else (node[:0], node[:0])


def links(prints: DataFrame) -> DataFrame:
    """``(a, b)``: links that connect what fingerprints at most ``MAX_BITS`` apart connect.

    ``prints``: distinct ``(fp, node)``. Each goes to its anchors; members of an anchor are
    compared with each other in streams sorted by anchor. An anchor with over ``CELL``
    members is dealt out again as blocks of pairs of parts, so no task holds it whole.
    """
    spark = prints.sparkSession
    cells = prints.mapInArrow(_to_anchors, "cell long, fp long, node long")
    shape = "a long, b long, cell long"
    found = materialize(
        cells.repartition("cell").sortWithinPartitions("cell", "fp").mapInArrow(_compare(CELL), shape), "links"
    )
    near = found.filter("cell IS NULL").select("a", "b")
    later = found.filter("cell IS NOT NULL").select("cell", F.col("b").alias("fp"), F.col("a").alias("node"))
    if later.isEmpty():
        return near
    parts = later.groupBy("cell").agg(F.ceil(F.count("*") / CELL).alias("parts"))
    part = F.pmod(F.xxhash64("fp"), F.col("parts"))
    pairs = later.join(parts, "cell").withColumn("own", part)
    pairs = pairs.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    block = F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other"))
    blocks = pairs.select(block.alias("cell"), "fp", "node")
    blocks = blocks.repartition("cell").sortWithinPartitions("cell", "fp")
    return near.unionAll(blocks.mapInArrow(_compare(None), shape).select("a", "b"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row.

    ``component_id`` is the smallest key among the documents that links connect with this
    one, itself included. Rows with equal fingerprints are one node, whatever their number, and
    rows that share a key are linked, whatever their texts: a key has one component.
    A null key has its fingerprint but no component. Empty input gives no rows.
    """
    own = materialize(fingerprints(docs, key, text, shingle), "fingerprints")
    prints = own.filter("key IS NOT NULL").groupBy("fp").agg(F.min("key").alias("node"))
    prints = materialize(prints, "prints")
    # keys that have several fingerprints link those
    several = own.filter("key IS NOT NULL").groupBy("key").agg(F.min("fp").alias("x"), F.max("fp").alias("y"))
    shared = own.join(several.filter("x != y").select("key"), "key").join(prints, "fp").select(F.col("key").alias("a"), F.col("node").alias("b"))
    roots = components(links(prints).unionAll(shared))
    named = prints.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("component"))
    return own.join(named, "fp", "left").select(
        F.col("key").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("key").isNotNull(), F.col("component")).alias("component_id"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents whose group has one with a smaller ``doc_id``.

    Rows without ``doc_id`` stay; rows that share one stand and fall together.
    """
    groups = near_duplicates(docs)
    kept = F.max(F.col("component_id") == F.col("doc_id"))
    gone = groups.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(kept.alias("kept")).filter("NOT kept")
    return without(docs, gone)
