"""Substring deduplication by super-k-mers of words."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PLAIN, Words, covered, gram_hashes, mix, ranges, sliding_min, string_buffers

#: Words of a window.
WINDOW = 13

#: Words of a minimiser.
MINIMISER = 3

#: Text that one group of documents and one bucket of super-k-mers should hold, in bytes.
GROUP_BYTES, BUCKET_BYTES = 4 << 20, 8 << 20

#: Stands for a null id: after all others.
_LAST = np.iinfo(np.int64).max


@dataclass
class Packed:
    """The distinct super-k-mers of some documents, in an order that depends on these alone."""

    words: Words
    joined: np.ndarray  # the words, one space after each
    start: np.ndarray  # byte where each word starts in it
    end: np.ndarray
    first: np.ndarray  # for each occurrence its first word,
    count: np.ndarray  # its number of windows,
    owner: np.ndarray  # its document's id
    which: np.ndarray  # and its distinct super-k-mer
    shown: np.ndarray  # for each distinct one an occurrence,
    least: np.ndarray  # the least id it occurs in
    bucket: np.ndarray  # and the hash of its minimiser


def pack(data: np.ndarray, at: np.ndarray, ids: np.ndarray, window: int, minimiser: int) -> Packed | None:
    """Cut texts into super-k-mers: maximal runs of windows with the same minimiser.

    The minimiser of a window is its k-gram of words with the most letters (so that frequent
    short words attract no windows), the least hash among such. Equal super-k-mers are one,
    with the least id.
    """
    words = Words(data, at, PLAIN)
    if len(words) < window:
        return None
    hashes = words.hashes()
    joined, start, end = words.joined()
    gram = gram_hashes(hashes, minimiser)
    size = np.minimum(end[minimiser - 1 :] - start[: len(gram)], 63).astype(np.uint64)
    order = ((np.uint64(63) - size) << np.uint64(58)) | (gram >> np.uint64(6))
    low = sliding_min(order, window - minimiser + 1)
    text = np.repeat(np.arange(len(words.of) - 1), np.diff(words.of))
    n = len(low)
    valid = text[:n] == text[window - 1 :]
    new = np.ones(n, bool)
    new[1:] = (low[1:] != low[:-1]) | (text[1:n] != text[: n - 1]) | ~valid[:-1]
    first = np.flatnonzero(new & valid)
    if not len(first):
        return None
    stops = np.append(np.flatnonzero(new | ~valid), n)
    count = stops[np.searchsorted(stops, first, "right")] - first
    owner = ids[text[first]]
    # equal ones: two hashes of the words together, then the bytes
    a, b = start[first], end[first + count + window - 2]
    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes + np.uint64(1)) * _places(len(hashes)))])
    sums = (total[first + count + window - 1] - total[first]) * _inverse(first)
    digest = mix(sums) ^ mix(hashes[first] + count.astype(np.uint64))
    sort = np.lexsort((owner, b - a, digest))
    differs = np.ones(len(sort), bool)
    differs[1:] = (digest[sort][1:] != digest[sort][:-1]) | ((b - a)[sort][1:] != (b - a)[sort][:-1])
    same = np.flatnonzero(~differs)
    if len(same):
        differs[same] = ~_equal_bytes(joined, a[sort[same]], a[sort[same - 1]], (b - a)[sort[same]])
    group = np.cumsum(differs) - 1
    which = np.empty(len(sort), np.int64)
    which[sort] = group
    shown = sort[np.flatnonzero(differs)]
    least = np.minimum.reduceat(owner[sort], np.flatnonzero(differs))
    return Packed(words, joined, start, end, first, count, owner, which, shown, least, low[first][shown])


_BASE = 0xD6E8FEB86659FD93
_BACK = pow(_BASE, -1, 1 << 64)


def _places(n: int) -> np.ndarray:
    out = np.full(n, np.uint64(_BASE))
    out[:1] = 1
    return np.multiply.accumulate(out)


def _inverse(at: np.ndarray) -> np.ndarray:
    """1 / base ** at, modulo 2 ** 64."""
    if not len(at):
        return np.zeros(0, np.uint64)
    out = np.full(int(at.max()) + 1, np.uint64(_BACK))
    out[0] = 1
    return np.multiply.accumulate(out)[at]


def _equal_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the bytes at ``a`` and ``b`` are the same, pair by pair."""
    out = np.empty(len(a), bool)
    step = 1 << 16
    for i in range(0, len(a), step):
        n = length[i : i + step]
        same = data[ranges(a[i : i + step], n)] == data[ranges(b[i : i + step], n)]
        out[i : i + step] = np.logical_and.reduceat(same, np.cumsum(n) - n)
    return out


def _requests(packed: Packed, window: int, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Bucket by bucket the distinct super-k-mers that go there, in the order of the texts."""
    bucket = (mix(packed.bucket) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((packed.shown, bucket))
    for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        yield int(bucket[part[0]]), part


def _send(window: int, minimiser: int, buckets: int):
    """Group of documents -> one row per bucket: counts and least ids, and the packed strings compressed."""

    def run(key, table):
        table = _sorted(table)
        packed = pack(*string_buffers(table.column("text")), _ids(table), window, minimiser)
        rows: list[tuple] = []
        squeeze = zstandard.ZstdCompressor(level=6)
        if packed:
            for bucket, part in _requests(packed, window, buckets):
                first, count = packed.first[packed.shown[part]], packed.count[packed.shown[part]]
                a, b = packed.start[first], packed.end[first + count + window - 2]
                text = packed.joined[ranges(a, b - a + 1)]
                text[np.cumsum(b - a + 1) - 1] = 0x0A
                rows.append((key[0].as_py(), bucket, squeeze.compress(packed.least[part].tobytes()), squeeze.compress(text.tobytes())))
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 4, _SENT, strict=True)], ["part", "bucket", "least", "packed"])

    return run


_SENT = (pa.int64(), pa.int64(), pa.binary(), pa.binary())


def _sorted(table: pa.Table) -> pa.Table:
    """A group's rows in an order that depends on their contents alone.

    ``_send`` and ``_apply`` read a group from two shuffles, whose blocks arrive in any order,
    and match bits to super-k-mers by position.
    """
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _ids(table: pa.Table) -> np.ndarray:
    return table.column("doc_id").combine_chunks().fill_null(_LAST).to_numpy(zero_copy_only=False).astype(np.int64)


def _count(window: int):
    """One bucket -> for each row sent to it a bit per window: does the window also start under a smaller id?

    Windows are sorted by hash, those of one hash are compared by their bytes.
    """

    def run(table):
        blow = zstandard.ZstdDecompressor()
        texts = [blow.decompress(x) for x in table.column("packed").to_pylist()]
        data = np.frombuffer(b"".join(texts), np.uint8)
        ids = [blow.decompress(x) for x in table.column("least").to_pylist()]
        least = np.frombuffer(b"".join(ids), np.int64)
        line = np.flatnonzero(data == 0x0A)
        words = Words(data, np.concatenate([[0], line + 1]), PLAIN)
        per = np.diff(words.of) - window + 1  # windows of each super-k-mer
        at = ranges(words.of[:-1], per)
        owner = np.repeat(least, per)
        hashes = gram_hashes(words.hashes(), window)[at]
        a, n = words.start[at], words.end[at + window - 1] - words.start[at]
        order = np.argsort(hashes, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = hashes[order][1:] != hashes[order][:-1]
        again = np.flatnonzero(~new)
        i, j = order[again], order[again - 1]
        same = n[i] == n[j]
        same[same] = _equal_bytes(data, a[i[same]], a[j[same]], n[i[same]])
        if same.all():
            runs = np.flatnonzero(new)
            low = np.repeat(np.minimum.reduceat(owner[order], runs), np.diff(np.append(runs, len(order)))) if len(order) else owner
            before = np.empty(len(order), bool)
            before[order] = low < owner[order]
        else:  # different windows of one hash
            raw, known = data.tobytes(), {}
            spans = [raw[x : x + y] for x, y in zip(a.tolist(), n.tolist(), strict=True)]
            for span, doc in zip(spans, owner.tolist(), strict=True):
                known[span] = min(doc, known.get(span, doc))
            before = np.array([known[s] for s in spans], np.int64) < owner
        sizes = np.array([len(x) // 8 for x in ids])
        stop = np.cumsum(np.add.reduceat(per, np.cumsum(sizes) - sizes)) if len(sizes) else sizes
        bits = np.split(before, stop[:-1])
        hit = [k for k, x in enumerate(bits) if x.any()]
        own = table.select(["part", "bucket"]).take(pa.array(hit, pa.int64()))
        return own.append_column("bits", pa.array([np.packbits(bits[k]).tobytes() for k in hit], pa.binary()))

    return run


def _apply(window: int, minimiser: int, buckets: int):
    """A group of documents and the answers for it -> what is left of each document."""

    def run(table, answers):
        table = _sorted(table)
        data, at = string_buffers(table.column("text"))
        ids = _ids(table)
        packed = pack(data, at, ids, window, minimiser)
        words = packed.words if packed else Words(data, at, PLAIN)
        gone = np.zeros(len(words), bool)
        if packed:
            known = dict(zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist(), strict=True))
            count = packed.count[packed.shown]
            place = np.cumsum(count) - count
            before = np.zeros(int(count.sum()), bool)
            for bucket, part in _requests(packed, window, buckets):
                if bucket in known:
                    n = int(count[part].sum())
                    before[ranges(place[part], count[part])] = np.unpackbits(np.frombuffer(known[bucket], np.uint8), count=n).astype(bool)
            # the window's least id is smaller than the least one here, or this document isn't the least here
            hit = before[ranges(place[packed.which], packed.count)]
            hit |= np.repeat(packed.owner > packed.least[packed.which], packed.count)
            start = ranges(packed.first, packed.count)[hit]
            gone = covered(len(words), start, np.full(len(start), window))
        joined, start, end = (packed.joined, packed.start, packed.end) if packed else words.joined()
        total, removed, digest, texts = [], [], [], []
        for d in range(table.num_rows):
            own = np.arange(words.of[d], words.of[d + 1])
            left = own[~gone[own]]
            kept = joined[ranges(start[left], end[left] - start[left] + 1)].tobytes()[:-1]
            total.append(len(own))
            removed.append(len(own) - len(left))
            digest.append(hashlib.sha256(kept).hexdigest())
            texts.append(kept)
        return pa.Table.from_arrays(
            [table.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string()), pa.array(texts, pa.binary()).cast(pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
        )

    return run


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, minimiser: int = MINIMISER) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, kept)`` for every row.

    A word goes if a window of ``window`` words that covers it also starts in a document with
    a smaller id; ``kept`` has the other words joined by one space. Repeats inside a document
    and rows with the same id don't count against each other; a null id comes after all
    others. Null and short texts keep all they have.

    Documents are dealt out in groups of a few MB. A group cuts its texts into super-k-mers,
    counts equal ones once, and sends each bucket one packed string; so a passage that is
    in a third of the documents reaches its bucket once per group. A bucket returns one bit
    per window, and the group, computed again, applies them.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-size // GROUP_BYTES))
    buckets = max(1, -(-3 * size // BUCKET_BYTES))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)))
    by_part = rows.groupBy("part")
    sent = by_part.applyInArrow(_send(window, minimiser, buckets), "part long, bucket long, least binary, packed binary")
    bits = sent.groupBy("bucket").applyInArrow(_count(window), "part long, bucket long, bits binary")
    return by_part.cogroup(bits.groupBy("part")).applyInArrow(
        _apply(window, minimiser, buckets), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    )
