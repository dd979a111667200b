"""Spelling variants: words one edit apart, by a trie of letter-group counts."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Letters fall into 16 groups by the last four bits of their code points. The order of the
#: trie's levels has the groups of frequent letters first: these tell most words apart.
ORDER = (5, 1, 15, 14, 9, 4, 3, 2, 12, 8, 0, 13, 7, 6, 10, 11)

#: A subtree with more words than the greater of LEAST and 1/BUCKETS of all is split below.
LEAST, BUCKETS = 8192, 1 << 14

#: Words of a leaf, which are verified one by one, and queries that are verified at once.
LEAF, BLOCK = 16, 4096

#: Longer words are compared one by one.
_WIDE = 48

#: A word's form occurs at least so many times as often.
RATIO = 10

_DIGITS = "0123456789abcdef"

#: The lowest bit of each of 16 numbers of four bits.
_ONES = np.uint64(0x1111111111111111)


def counts_of(words: list[str]) -> np.ndarray:
    """How many letters of each group (in ``ORDER``) each word has, 15 at most."""
    code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    found = np.bincount(row * 16 + (code & 15), minlength=16 * len(words)).reshape(-1, 16)
    return np.minimum(found, 15).astype(np.int8)[:, ORDER]


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digit = np.frombuffer(_DIGITS.encode(), np.uint8)
    for batch in batches:
        raw = digit[counts_of(batch.column("word").to_pylist())].tobytes()
        at = np.arange(0, len(raw) + 1, 16, dtype=np.int32)
        vec = pa.StringArray.from_buffers(batch.num_rows, pa.py_buffer(at), pa.py_buffer(raw))
        yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), vec], ["word", "n", "vec"])


#: What a word on its way down may have spent, by the step of a node's count against its own:
#: nothing yet, the deficit alone, the surplus (the deficit must follow), or both. Of two words
#: one visits the other: the one that has more, or at the first difference less. Words with
#: one vector meet in one leaf.
_FREE, _LESS, _MORE, _BOTH = range(4)
_NEXT = {(_FREE, 0): _FREE, (_FREE, -1): _LESS, (_FREE, 1): _MORE, (_LESS, 0): _LESS, (_MORE, 0): _MORE, (_MORE, -1): _BOTH, (_BOTH, 0): _BOTH}
_AFTER = np.array([[_NEXT.get((spent, step), -1) for step in (0, 1, -1)] for spent in range(4)], np.int8)  # by step 0, 1, -1


def routes(vec: str, split: dict[str, tuple[str, int]]) -> list[tuple[str, int]]:
    """``(bucket, parts)`` of the subtrees in which a word with that vector looks for near ones.

    Depth first through the split nodes: a child may hold one letter of a group more (the
    surplus, spent once) and one of a group less (the deficit, spent once).
    """
    out, todo = [], [("", _FREE)]
    while todo:
        node, spent = todo.pop()
        children, parts = split.get(node, ("", 1))
        if node not in split or len(node) == len(vec):
            if len(node) < len(vec) or spent != _MORE:
                out.append((node, parts))
            continue
        own = _DIGITS.index(vec[len(node)])
        for d in _DIGITS[own - 1 if own and spent in (_FREE, _MORE) else own : own + 2 if spent == _FREE else own + 1]:
            if d in children:
                todo.append((node + d, _NEXT[spent, _DIGITS.index(d) - own]))
    return out


def _router(split: dict[str, tuple[str, int]]):
    import zlib

    def home(vec: str) -> str:
        n = 0
        while vec[:n] in split and n < len(vec):
            n += 1
        return vec[:n]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[str, list]] = {}
        for batch in batches:
            word, bucket, part, at_home = [], [], [], []
            for i, (w, vec) in enumerate(zip(batch.column("word").to_pylist(), batch.column("vec").to_pylist(), strict=True)):
                if vec not in known:
                    if len(known) > 50_000:
                        known = {}
                    known[vec] = home(vec), routes(vec, split)
                own, to = known[vec]
                for node, parts in to:
                    mine = zlib.crc32(w.encode()) % parts if node == own else -1
                    for p in range(parts):
                        word.append(i)
                        bucket.append(node)
                        part.append(p)
                        at_home.append(p == mine)
            i = pa.array(word, pa.int32())
            columns = [pa.array(bucket, pa.string()), pa.array(part, pa.int32()), pa.array(at_home, pa.bool_())]
            columns += [batch.column("word").take(i), batch.column("n").take(i)]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "part", "home", "word", "n"])

    return run


def near(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point turns one into the other."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i:] == b[i + 1 :] if len(a) < len(b) else a[i + 1 :] == b[i + 1 :]


class Bucket:
    """The subtree of the words at home in one bucket, and the search in it."""

    def __init__(self, words: list[str], home: np.ndarray):
        self.words = words
        self.size = np.array([len(w) for w in words])
        self.vec = counts_of(words)
        self.packed = (self.vec.astype(np.uint64) << np.arange(0, 64, 4, dtype=np.uint64)).sum(1, dtype=np.uint64)
        own = np.flatnonzero(home)
        self.own = own[np.lexsort(self.vec[own].T[::-1])]
        wide = np.where(self.size <= _WIDE)[0]
        flat = np.frombuffer("".join(words[i] for i in wide).encode("utf-32-le"), np.uint32)
        kind = np.uint8 if not len(flat) or flat.max() < 256 else np.uint32
        width = int(self.size[wide].max(initial=0)) + 1
        self.left = np.zeros((len(words), width), kind)
        self.right = np.zeros((len(words), width), kind)
        if len(wide):
            row = np.repeat(wide, self.size[wide])
            first = np.cumsum(self.size[wide]) - self.size[wide]
            column = np.arange(len(flat)) - np.repeat(first, self.size[wide])
            self.left[row, column] = flat
            self.right[row, np.repeat(self.size[wide], self.size[wide]) - 1 - column] = flat
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def search(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (any word, word at home) that are one edit apart, each once."""
        everyone = np.arange(len(self.words))
        self._descend(0, 0, len(self.own), everyone, np.full(len(everyone), _FREE, np.int8))
        if not self.pairs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(c) for c in zip(*self.pairs, strict=True))

    def _descend(self, level: int, low: int, high: int, who: np.ndarray, spent: np.ndarray) -> None:
        """``who`` are the words that reach this node, with what they have spent."""
        if level == len(ORDER) or high - low <= LEAF:
            if level == len(ORDER):
                who = who[spent != _MORE]
            for i in range(0, len(who), BLOCK):
                self._verify(who[i : i + BLOCK], self.own[low:high])
            return
        value = self.vec[self.own[low:high], level]
        start = np.flatnonzero(np.diff(value, prepend=-1))
        mine = self.vec[who, level]
        for a, b in zip(start.tolist(), [*start[1:].tolist(), high - low], strict=True):
            step = value[a] - mine
            small = np.flatnonzero((step >= -1) & (step <= 1))
            after = _AFTER[spent[small], step[small]]
            go = after >= 0
            if go.any():
                self._descend(level + 1, low + a, low + b, who[small[go]], after[go])

    def _verify(self, who: np.ndarray, own: np.ndarray) -> None:
        for j in own.tolist() if len(own) > LEAF else [None]:  # many words of one vector: one after the other
            other = own if j is None else np.array([j])
            # at most two groups differ: counts are compared four bits each, all at once
            bits = self.packed[who][:, None] ^ self.packed[other][None]
            bits |= bits >> np.uint64(2)
            bits |= bits >> np.uint64(1)
            q, k = np.nonzero(np.bitwise_count(bits & _ONES) <= 2)
            q, k = who[q], other[k]
            close = (np.abs(self.size[q] - self.size[k]) <= 1) & (q != k)
            q, k = q[close], k[close]
            # surplus and deficit of one at most, the surplus first
            step = self.vec[k] - self.vec[q]
            off, total = np.abs(step).sum(1), step.sum(1)
            first = step[np.arange(len(q)), (step != 0).argmax(1)]
            visit = np.where(off == 1, total == -1, (off == 2) & (total == 0) & (first == 1))
            for i in np.flatnonzero(off == 0).tolist():  # one vector: each finds the other, one of them counts
                visit[i] = self.words[q[i]] < self.words[k[i]]
            q, k = q[visit], k[visit]
            short = np.maximum(self.size[q], self.size[k]) <= _WIDE
            good = np.zeros(len(q), bool)
            # equal letters from the left and from the right cover all of the shorter word but a replaced letter
            lcp = (self.left[q[short]] != self.left[k[short]]).argmax(1)
            lcs = (self.right[q[short]] != self.right[k[short]]).argmax(1)
            least = np.minimum(self.size[q], self.size[k])[short]
            good[short] = lcp + lcs >= least - (self.size[q] == self.size[k])[short]
            for i in np.flatnonzero(~short).tolist():
                good[i] = near(self.words[q[i]], self.words[k[i]])
            if good.any():
                self.pairs.append((q[good], k[good]))


_FOUND = "word string, n_near long, best_n long, best string"


def _search(table: pa.Table) -> pa.Table:
    words = table.column("word").to_pylist()
    n = table.column("n").to_numpy()
    home = table.column("home").to_numpy(zero_copy_only=False)
    q, k = Bucket(words, home).search() if home.any() else (np.zeros(0, np.int64),) * 2
    q, k = np.concatenate([q, k]), np.concatenate([k, q])
    # the best of a word's near ones: the most frequent, then the first in code-point order
    at, q = np.unique(q, return_inverse=True)
    order = sorted(at.tolist(), key=lambda i: (-n[i], words[i]))
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(order))
    best = np.full(len(at), len(order), np.int64)
    np.minimum.at(best, q, place[k])
    chosen = [order[b] for b in best.tolist()]
    columns = [[words[i] for i in at.tolist()], np.bincount(q, minlength=len(at)), n[chosen] if chosen else [], [words[i] for i in chosen]]
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["word", "n_near", "best_n", "best"])


def variants(counts: DataFrame) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for distinct words ``(word, n)``.

    Two words are near if one inserted, deleted or replaced code point tells them apart.
    ``n_near`` counts a word's near words; ``form`` is the one with the largest n (ties: the
    first in code-point order) if that is at least ten times the word's own, else null;
    ``root`` follows forms to the last. A null word is left out; an empty table gives none.

    Words hang in a trie of their letter-group counts. The nodes above a bounded number of
    words are split, and the split nodes, at most 17 x ``BUCKETS``, go to all tasks; a
    subtree that isn't split is one group, so a group has few words, whatever the words are.
    Each word searches the subtrees that a surplus and a deficit of one letter reach, each
    pair from one side. Words with the same full vector beyond the bound are dealt into
    parts. Pairs stay in their task; only each word's count and best near word leave it.
    """
    counts = counts.select(F.col("word").cast("string").alias("word"), F.col("n").cast("long").alias("n")).filter("word IS NOT NULL")
    keyed = materialize(counts.mapInArrow(_vectors, "word string, n long, vec string"), "vectors")
    limit = max(LEAST, math.ceil(keyed.count() / BUCKETS))
    level = F.explode(F.sequence(F.lit(0), F.lit(len(ORDER)))).alias("level")
    nodes = keyed.select("vec", level).select(F.expr("left(vec, level)").alias("node"), F.expr("substring(vec, level + 1, 1)").alias("child"))
    nodes = nodes.groupBy("node").agg(F.count("*").alias("words"), F.collect_set("child").alias("children"))
    split = {r[0]: ("".join(sorted(r[2])), math.ceil(r[1] / limit)) for r in nodes.filter(F.col("words") > limit).collect()}
    sent = keyed.mapInArrow(_router(split), "bucket string, part int, home boolean, word string, n long")
    found = sent.groupBy("bucket", "part").applyInArrow(_search, _FOUND)
    found = found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("best")
    )
    joined = keyed.select("word", "n").join(found, "word", "left")
    enough = -F.col("best.n") >= RATIO * F.col("n")
    rows = joined.select(
        "word",
        F.when(enough, F.col("best.word")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, -F.col("best.n")).alias("form_n"),
    )
    rows = materialize(rows, "forms")
    out = rows.join(_roots(rows.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(links: DataFrame) -> DataFrame:
    """``(word, root)``: each round doubles the steps that are taken; forms grow tenfold per step, so few are needed."""
    while True:
        links = materialize(links, "roots")
        further = links.select(F.col("word").alias("root"), F.col("root").alias("top"))
        if links.join(further, "root", "left_semi").isEmpty():
            return links
        links = links.join(further, "root", "left").select("word", F.coalesce("top", "root").alias("root"))


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 7, often: int = 2) -> DataFrame:
    """``(word, n)``: runs of Latin letters, a-z lower-cased, with letters deleted here and there.

    With h the crc32 of ``<key>:<run>``: if 31 divides h, the run's code point h mod length is
    deleted. Results with ``least`` code points that occur ``often`` or more are returned. A
    null text has no words, a null key is written as the empty text.
    """
    run = r"([A-Za-zÀ-ÿ]{%d,})" % least  # a maximal run, as a shorter one can't become a word
    low = F.translate(F.col(text).cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(low, F.lit(run), F.lit(1))).alias("run"))
    hashed = found.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    spoiled = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % 31 == 0, spoiled).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= often)
