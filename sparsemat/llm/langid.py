"""Language identification by cross-parsing: how few phrases of a language's sample make up a text."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize, slices

#: Bounds of the training sample of each language: documents, characters of one of them, and
#: characters of distinct words that go into its automaton.
SAMPLE_DOCS, SAMPLE_CHARS, AUTOMATON_CHARS = 400, 2_000, 60_000

#: The verdict on a text without a letter.
UNKNOWN = "und"

#: Letters from which on a word is parsed by itself, and walks that are taken in step at once.
LONG, WALKS = 64, 1 << 16

_LETTERS = regex.compile(r"\p{L}+")


class Automaton:
    """Suffix automaton of a text; walks from the root spell exactly its substrings."""

    def __init__(self, text: str):
        self.next: dict[int, int] = {}  # state * 2**21 + character -> state
        link, length, edges = [-1], [0], [{}]
        last = 0
        for ch in text:
            c, new = ord(ch), len(length)
            length.append(length[last] + 1)
            link.append(0)
            edges.append({})
            p = last
            while p >= 0 and c not in edges[p]:
                edges[p][c] = new
                p = link[p]
            if p >= 0:
                q = edges[p][c]
                if length[p] + 1 == length[q]:
                    link[new] = q
                else:
                    copy = len(length)
                    length.append(length[p] + 1)
                    link.append(link[q])
                    edges.append(dict(edges[q]))
                    while p >= 0 and edges[p].get(c) == q:
                        edges[p][c] = copy
                        p = link[p]
                    link[q] = link[new] = copy
            last = new
        self.next = {(s << 21) + c: t for s, out in enumerate(edges) for c, t in out.items()}
        self.size = len(text)

    def phrases(self, codes: list[int]) -> int:
        """Longest matches that ``codes`` is cut into, from the left; a character that never occurs is one."""
        step, n, i, found = self.next.get, len(codes), 0, 0
        while i < n:
            state, start = 0, i
            while i < n and (state := step((state << 21) + codes[i])) is not None:
                i += 1
            if i == start:
                i += 1
            found += 1
        return found


def held_out(key: Column) -> Column:
    """Rows that no model is fitted on: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, Automaton]:
    """An automaton per language from a bounded sample of the labelled rows that are not held out.

    Per language at most ``SAMPLE_DOCS`` documents, chosen by a hash of id and text (so that
    rows without an id are told apart, and copies of one row count once), each giving at most ``SAMPLE_CHARS`` characters from a place that the hash picks; of their words,
    distinct ones in order of appearance, up to ``AUTOMATON_CHARS`` characters. Only this
    sample comes to the driver. Without labelled rows the model is empty.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("key")))
    counts = materialize(rows.groupBy("lang").agg(F.count("*").alias("n")), "languages")  # of known size, so texts stay where they are
    h = F.xxhash64(F.col("key").cast("string"), "text", F.lit("sample"))
    rows = rows.withColumn("h", h).join(counts, "lang").filter(F.pmod("h", F.col("n")) < SAMPLE_DOCS)
    start = F.pmod(F.shiftright("h", 7), F.greatest(F.length("text") - SAMPLE_CHARS + 1, F.lit(1)))
    rows = rows.select("lang", "h", F.col("text").substr((start + 1).cast("int"), F.lit(SAMPLE_CHARS)).alias("text"))
    rows = rows.groupBy("lang", "h").agg(F.min("text").alias("text"))
    sample: dict[str, list[tuple[int, str]]] = {}
    for r in rows.toLocalIterator():
        sample.setdefault(r["lang"], []).append((r["h"], r["text"]))
    model = {}
    for name in sorted(sample):
        words: dict[str, None] = {}
        size = 0
        for _, piece in sorted(sample[name])[:SAMPLE_DOCS]:
            for word in _LETTERS.findall(piece.lower()):
                if word not in words and size <= AUTOMATON_CHARS:
                    words[word] = None
                    size += len(word) + 1
        if words:
            model[name] = Automaton(" " + " ".join(words) + " ")
    return model


class Walks:
    """Phrases of many words in several automata, all walked in step.

    The transitions of all automata are one hash table with open addressing, looked up for
    all walks at once.
    """

    def __init__(self, automata: list[Automaton]):
        self.automata = automata
        states = [1 + max(a.next.values(), default=0) for a in automata]
        self.roots = np.cumsum([0, *states])[:-1]
        edges = [(np.fromiter(a.next.keys(), np.int64, len(a.next)) + (root << 21), np.fromiter(a.next.values(), np.int64, len(a.next)) + root) for a, root in zip(automata, self.roots.tolist(), strict=True)]
        keys, to = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*edges, strict=True)) if edges else (np.zeros(0, np.int64),) * 2
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.to = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int64)
        at, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] < 0]
            self.keys[at[free]] = keys[free]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & self.mask
        self.to[at] = to

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _step(self, keys: np.ndarray) -> np.ndarray:
        """Where each transition leads, -1 if there is none."""
        at = self._slots(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.to[at], -1)
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        at = at[open_]
        while len(open_):
            at = (at + 1) & self.mask
            held = self.keys[at]
            hit = held == keys[open_]
            out[open_[hit]] = self.to[at[hit]]
            more = ~hit & (held >= 0)
            open_, at = open_[more], at[more]
        return out

    def phrases(self, words: list[str]) -> np.ndarray:
        """Phrases of each word between two spaces, a column per automaton; words hold no space."""
        out = np.zeros((len(words), len(self.automata)), np.int64)
        step = max(1, WALKS // max(1, len(self.automata)))
        for i in range(0, len(words), step):
            part = words[i : i + step]
            out[i : i + step] = self._part(part)
            for k in [k for k, word in enumerate(part) if len(word) >= LONG]:
                out[i + k] = [a.phrases([32, *map(ord, part[k]), 32]) for a in self.automata]
        return out

    def _part(self, words: list[str]) -> np.ndarray:
        codes = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le"), np.uint32).astype(np.int64)
        lens = np.fromiter(map(len, words), np.int64, len(words))
        start, short = np.cumsum(lens + 1) - lens - 1, np.flatnonzero(lens < LONG)
        n = len(self.automata)
        at, end = np.tile(start[short], n), np.tile((start + lens + 2)[short], n)
        root = np.repeat(self.roots, len(short))
        state, walk, found = root, np.arange(len(at)), np.zeros(len(at), np.int64)
        while len(walk):
            to = self._step((state << 21) + codes[at])
            goes = to >= 0
            at = at + (goes | (state == root))  # a character that never occurs is a phrase
            state = np.where(goes, to, root)
            left = at < end
            found[walk] += ~goes | (~left & goes)
            at, end, root, state, walk = at[left], end[left], root[left], state[left], walk[left]
        out = np.zeros((len(words), n), np.int64)
        out[short] = found.reshape(n, len(short)).T
        return out


class Judge:
    """Phrases of words; a word stands between spaces and phrases end with it."""

    def __init__(self, model: dict[str, Automaton]):
        self.names = list(model)
        self.walks = Walks(list(model.values()))
        # normalised: the bits that name a place in the sample, per letter of the text
        self.bits = np.array([math.log2(a.size + 1) for a in model.values()])

    def texts(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        lower = pc.utf8_lower(pc.fill_null(column, ""))
        lists = pc.split_pattern_regex(lower, r"[^\p{L}]+")
        flat = pc.list_flatten(lists)
        rows = pc.list_parent_indices(lists).to_numpy()
        encoded = flat.dictionary_encode()
        letters = pc.utf8_length(encoded.dictionary).to_numpy(zero_copy_only=False).astype(np.float64)
        cost = self.walks.phrases(encoded.dictionary.to_pylist()) * (letters > 0)[:, None]
        index, n = encoded.indices.to_numpy(zero_copy_only=False), len(column)
        total = np.bincount(rows, letters[index], n)
        costs = np.stack([np.bincount(rows, cost[index, k], n) * self.bits[k] for k in range(len(self.names))]) if self.names else np.zeros((0, n))
        if not self.names:
            return [UNKNOWN] * n, np.zeros(n)
        best = costs.argmin(0)
        low = costs.min(0)
        second = np.partition(costs, 1, 0)[1] if len(self.names) > 1 else np.full(n, np.inf)
        with np.errstate(all="ignore"):
            score = np.where(np.isinf(second), 1.0, second / (low + second))
        named = total > 0
        return [self.names[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), named.tolist(), strict=True)], np.where(named, score, 0.0)


def identify(docs: DataFrame, model: dict[str, Automaton], text: str = "text", into: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` and two columns more: the language, and a score from 0.5 (a tie) to 1.

    The language is the one of least phrases times the bits that name a place in its
    sample (the first by name in a tie). The score is the runner-up's cost over both costs,
    1 if there is one language. Null texts and texts without a letter are ``und`` with score
    0. Whole texts are read; no other column is.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(sent.value)
        for batch in batches:
            for part in slices(batch, text):
                names, score = judge.texts(part.column(text))
                columns = [*part.columns, pa.array(names, pa.string()), pa.array(score, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, *into])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return docs.mapInArrow(run, ", ".join([*kinds, f"`{into[0]}` string", f"`{into[1]}` double"]))


def languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every row, by a model of the rows not held out.

    A null key counts as not held out.
    """
    model = fit(docs, key, text, lang)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return identify(rows, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def known_only(docs: DataFrame, lang: str = "lang") -> DataFrame:
    """``docs`` without those whose text is in no language (null or no letter), unlabelled ones labelled.

    A null ``lang`` becomes the predicted language. Where no row is labelled there is no
    model, nothing can be judged, and all rows stay as they are.
    """
    model = fit(docs, lang=lang)
    if not model:
        return docs
    into = (fresh(docs, "_lang_pred"), fresh(docs, "_score"))
    judged = identify(docs, model, "text", into).filter(F.col(into[0]) != UNKNOWN)
    return judged.withColumn(lang, F.coalesce(F.col(lang), F.col(into[0]))).select(*docs.columns)
