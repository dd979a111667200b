"""Periodic runs of words by string synchronising sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _ODD, PLAIN, Words, covered, mix, sliding_min, slices, string_buffers

#: Least number of repetitions of a run, and its least length in words.
EXPONENT, SHORTEST = 4, 6

#: The first dyadic scale. Smaller periods have no scale and are looked for word by word.
BASE = 4

_HIDDEN = np.uint64(0xFFFFFFFFFFFFFFFF)


def word_ids(words: Words) -> np.ndarray:
    """Equal words have equal numbers, different words different ones."""
    lens = words.end - words.start
    offsets = np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)
    own = np.ascontiguousarray(words.data[words.mask])
    flat = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lens), [None, pa.py_buffer(offsets), pa.py_buffer(own)])
    return flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def synchronising(ident: np.ndarray, scale: int, hidden: np.ndarray) -> np.ndarray:
    """Positions i where the least identifier of windows i to i+scale is that of i or of i+scale.

    ``ident`` holds an identifier of each window of ``scale`` words; ``hidden`` windows, the
    highly periodic ones, are never the least. Whether i is chosen depends on the words
    i to i + 2 scale alone, and of ``scale`` positions in a row one is chosen unless all
    windows around are hidden.
    """
    ident = np.where(hidden, _HIDDEN, ident)
    least = sliding_min(ident, scale + 1)
    return np.flatnonzero((least != _HIDDEN) & ((ident[: len(least)] == least) | (ident[scale:] == least)))


def _stretch(x: np.ndarray, i: int, p: int) -> tuple[int, int]:
    """Start and end of the longest stretch around i and i + p in which words p apart are equal."""
    n, j, step = len(x) - p, i, 64
    while j < n:
        other = x[j : min(j + step, n)] != x[j + p : min(j + step, n) + p]
        at = int(other.argmax())
        if other[at]:
            j += at
            break
        j, step = j + len(other), step * 2
    end, j, step = j + p, i, 64
    while j > 0:
        low = max(0, j - step)
        other = np.flatnonzero(x[low:j] != x[low + p : j + p])
        if len(other):
            return low + int(other[-1]) + 1, end
        j, step = low, step * 2
    return 0, end


def _small(x: np.ndarray, p: int) -> np.ndarray:
    """``(start, end, period)`` of each stretch of period p, word by word."""
    same = np.flatnonzero(x[:-p] == x[p:]) if len(x) > p else np.zeros(0, np.int64)
    first = np.flatnonzero(np.diff(same, prepend=-2) != 1)
    size = np.diff(np.append(first, len(same)))
    good = size >= (EXPONENT - 1) * p
    start = same[first[good]]
    return np.stack([start, start + size[good] + p, np.full(len(start), p)], 1)


def runs(ids: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(text, start, length, period)`` of every run in many texts of word numbers.

    ``of`` has the place of each text's first word (n+1 entries). At scale s = 4, 8, 16, ..
    neighbouring members of the synchronising set with equal contexts (2 s words), s to
    2 s - 1 apart, propose their distance as a period; the stretch around them is then
    compared word by word. Every run of a period p in that range is proposed: it has 4 p
    words, so a member lies in its first s positions, and the same context p further on is
    the next one. Windows inside stretches found so far with a period of at most s / 4 are
    the hidden ones. Windows are told apart by 64-bit hashes. Periods below 4 are found
    without a scale. A multiple of a period gives the same stretch; the least one stays.
    """
    size, n = np.diff(of), len(of) - 1
    x = np.empty(len(ids) + n, np.int64)
    ends = of[1:] + np.arange(n)  # after each text a word that occurs nowhere else
    inside = np.ones(len(x), bool)
    inside[ends] = False
    x[inside], x[ends] = ids, -1 - np.arange(n)
    found = [_small(x, p) for p in range(1, BASE)]
    own, here, h, scale = np.repeat(size, size + 1), np.arange(len(x)), mix(x.view(np.uint64)), 1
    while True:
        if scale >= BASE:
            keep = own >= EXPONENT * scale
            if not keep.any():
                break
            if not keep.all():  # only texts that are long enough for the scale
                h, x, own, here = h[keep[: len(h)]], x[keep], own[keep], here[keep]
            if len(h) > scale:
                found.append(_at_scale(x, h, here, scale, np.concatenate(found)))
        if len(h) <= scale:
            break
        h, scale = mix(h[:-scale] * _ODD + h[scale:]), 2 * scale
    start, end, period = np.concatenate(found).T
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    new &= end - start >= SHORTEST
    text = np.searchsorted(ends, start[new])
    return text, start[new] - text - of[text], (end - start)[new], period[new]


def _at_scale(x: np.ndarray, h: np.ndarray, here: np.ndarray, scale: int, found: np.ndarray) -> np.ndarray:
    small = found[(found[:, 2] * EXPONENT <= scale) & (found[:, 1] - found[:, 0] >= scale)]
    at = np.searchsorted(here, small[:, 0])
    good = at < len(here)
    good[good] = here[at[good]] == small[good, 0]
    count = np.minimum((small[:, 1] - small[:, 0])[good] - scale + 1, len(h) - at[good])
    chosen = synchronising(h, scale, covered(len(h), at[good], np.maximum(count, 0)))
    context = mix(h[chosen] * _ODD + h[chosen + scale])
    order = np.argsort(context, kind="stable")
    context, place = context[order], chosen[order]
    apart = np.diff(place)
    pair = (context[1:] == context[:-1]) & (apart >= scale) & (apart < 2 * scale)
    place, apart = place[:-1][pair], apart[pair]
    order = np.lexsort((place, apart))
    out, period, end = [], 0, 0
    for i, p in zip(place[order].tolist(), apart[order].tolist(), strict=True):
        if p == period and i + p < end:
            continue  # a pair of the stretch just seen
        start, end = _stretch(x, i, p)
        period = p
        if end - start >= EXPONENT * p:
            first = int(here[start])
            out.append((first, first + end - start, p))
    return np.array(out, np.int64).reshape(-1, 3)


def _collapse(words: Words, gone: np.ndarray, n: int) -> pa.Array:
    """The words that stay, joined by one space, as a text each."""
    out, start, end = words.joined()
    size = end - start + 1
    stay = np.repeat(~gone, size)
    kept = np.flatnonzero(~gone)
    count = np.searchsorted(kept, words.of)
    has = count[1:] > count[:-1]
    stay[end[kept[count[1:][has] - 1]]] = False  # no space after a text's last word
    total = np.concatenate([[0], np.cumsum(stay)])
    at = np.append(start, len(out))[words.of]
    return pa.StringArray.from_buffers(n, pa.py_buffer(total[at].astype(np.int32)), pa.py_buffer(out[stay]))


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            words = Words(*string_buffers(part.column("text")), PLAIN)
            text, start, length, period = runs(word_ids(words), words.of)
            gone = covered(len(words), words.of[text] + start + period, length - period)
            offsets = np.searchsorted(text, np.arange(part.num_rows + 1)).astype(np.int32)
            rows = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (start, length, period)], ["start", "length", "period"])
            found = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)
            kept = _collapse(words, gone, part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column("key"), found, kept], ["key", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, runs, collapsed)`` for every row; the key column keeps its name.

    ``runs`` lists ``(start, length, period)`` in words, by start, then period: each stretch
    of consecutive words with smallest period q and at least ``max(6, 4 q)`` words that no
    neighbour extends. ``collapsed`` is the text without the words that a run holds after
    its first q, joined by one space. Null and empty texts have no runs and collapse to the
    empty text. A row is judged by itself, in its task: keys may be null or repeated, other
    columns are not looked at, and an empty table gives no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    schema = f"key {kind}, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return rows.mapInArrow(_search, schema).withColumnRenamed("key", key)


def planted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, text)`` of every row, a tenth of them made periodic from some word on.

    With h the crc32 of the key as decimal text and g = h / 10: if 10 divides h, word i of n
    from a = g mod n on becomes word a + (i - a) mod p, p = 1 + (n - a) / (3 + g mod 8), and
    words are joined by one space. Rows without a key or without words stay as they are.
    """
    h = F.crc32(F.col(key).cast("string").cast("binary"))

    def repeat(w):
        n = F.size(w).cast("long")
        g = F.expr("1L") * F.floor(h / 10)
        a = F.pmod(g, n)
        p = F.lit(1).cast("long") + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))
        at = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)))
        return F.array_join(F.transform(at, lambda i: F.get(w, i.cast("int"))), " ")

    words = F.regexp_extract_all(F.col(text).cast("string"), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    # an array of one array, so that the words are looked for once
    made = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeat(w)).otherwise(""))[0]
    return docs.select(F.col(key), F.when((F.pmod(h, F.lit(10)) == 0) & F.col(text).isNotNull(), made).otherwise(F.col(text).cast("string")).alias(text))


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Numbers and digests of :func:`periodic_runs`: the run of greatest exponent, and all of them."""

    def before(a, b):
        # the greater length / period first, compared without rounding; then start, period
        one, two = a["length"] * b["period"], b["length"] * a["period"]
        rest = F.when(a["start"] != b["start"], F.signum(a["start"] - b["start"])).otherwise(F.signum(a["period"] - b["period"]))
        return F.when(one > two, -1).when(one < two, 1).otherwise(rest).cast("int")

    best = F.get(F.array_sort("runs", before), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    picked = found.select(key, "runs", "collapsed", best.alias("best"))
    return picked.select(
        key,
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
