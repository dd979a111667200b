"""Spelling variants, packing and periodic runs against plain Python."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sparsemat.llm import byte_pieces, catalog, packing, periodic, spelling

SF_DIR = "/root/testdata/sf0.001"
BYTES = public_tokenizers.path(catalog.COUNTS)


@pytest.fixture(scope="module")
def pairs(spark):
    return [tuple(r) for r in catalog.table(spark, SF_DIR, "documents").select("doc_id", "text").collect()]


# ---------------------------------------------------------------- periodic runs


def numbered(texts: list[list]) -> tuple[np.ndarray, np.ndarray]:
    of = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    names = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
    return np.array([names[w] for t in texts for w in t], np.int64), of


def runs_of(texts: list[list]) -> list[list[tuple]]:
    out = [[] for _ in texts]
    for text, *run in zip(*periodic.runs(*numbered(texts)), strict=True):
        out[text].append(tuple(int(x) for x in run))
    return [sorted(r) for r in out]


def test_runs_of_random_words():
    rng = random.Random(5)
    texts = [[]]
    for _ in range(400):
        words = [rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):  # a block repeated, with a remainder, between others
            block = [rng.choice("abcde") for _ in range(rng.randint(1, 40))]
            words += block * rng.randint(2, 7) + block[: rng.randint(0, len(block))] + [rng.choice("abc")]
        texts.append(words)
    assert runs_of(texts) == [brute.periodic_runs(t) for t in texts]


def test_runs_within_runs_and_long_periods():
    rng = random.Random(6)
    inner = (["a", "b"] * 9 + [str(rng.random()) for _ in range(5)]) * 6
    long = [str(rng.randint(0, 50)) for _ in range(700)]
    nested = (inner + ["x"]) * 5
    fib = ["a"], ["b"]
    for _ in range(11):
        fib = fib[1], fib[0] + fib[1]
    texts = [inner, nested, long * 4, long * 4 + long[:3], long * 3, fib[1], ["z"] * 5, ["z"] * 6, ["z"] * 1000]
    assert runs_of(texts) == [brute.periodic_runs(t) for t in texts]
    assert runs_of([t]) == [brute.periodic_runs(t) for t in [texts[1]]] if (t := texts[1]) else True


def test_synchronising_sets_are_dense_and_consistent():
    rng = np.random.RandomState(3)
    ident = rng.randint(0, 1 << 62, 4000).astype(np.uint64)
    ident[2000:2400] = ident[1000:1400]
    for scale in (4, 16, 64):
        chosen = periodic.synchronising(ident, scale, np.zeros(len(ident), bool))
        assert np.diff(chosen).max() <= scale
        inside = chosen[(chosen >= 1000) & (chosen < 1400 - scale)]
        assert set(inside + 1000) == set(chosen[(chosen >= 2000) & (chosen < 2400 - scale)])


def test_periodic_query(spark, pairs, same):
    expected = [brute.run_digests(d, brute.planted(d, t)) for d, t in pairs]
    assert sum(e[1] > 0 for e in expected) > 10
    same(catalog.op13_periodic_runs(spark, SF_DIR), expected)


def test_periodic_runs_of_awkward_texts(spark, docs, none, rows, same):
    expected = [brute.run_digests(r[0], brute.planted(r[0], r[1])) for r in rows]
    same(periodic.digests(periodic.periodic_runs(periodic.planted(docs))), expected)
    plain = [(r[0], [], " ".join(brute.PLAIN.findall(r[1] or ""))) for r in rows if not brute.periodic_runs(brute.PLAIN.findall(r[1] or ""))]
    found = [(r.doc_id, r.runs, r.collapsed) for r in periodic.periodic_runs(docs).collect() if not r.runs]
    assert sorted(found, key=repr) == sorted(plain, key=repr)
    assert periodic.digests(periodic.periodic_runs(periodic.planted(none))).count() == 0


# ---------------------------------------------------------------- packing


def lower_bound(lengths, limit=1024) -> int:
    """No packing needs fewer: the sum, or for some k pieces over limit - k with those from k on beside them."""
    counts = np.bincount(lengths, minlength=limit + 1).astype(np.int64)
    size = np.arange(limit + 1) * counts
    best = -(-int(size.sum()) // limit)
    for k in range(limit // 2 + 1):
        big = int(counts[limit - k + 1 :].sum())
        middle = int(counts[limit // 2 + 1 : limit - k + 1].sum())
        rest = int(size[limit // 2 + 1 : limit - k + 1].sum()) + int(size[k : limit // 2 + 1].sum())
        best = max(best, big + middle + max(0, -(-(rest - middle * limit) // limit)))
    return best


def check_plan(counts: dict[int, int], limit: int = 1024) -> packing.Plan:
    plan = packing.Plan(counts, limit)
    fill: dict[int, list] = defaultdict(list)
    ranks = Counter()
    for n, rank, count, sequence, offset in zip(*(c.tolist() for c in plan.arrays()), strict=True):
        assert rank == ranks[n]
        ranks[n] += count
        for k in range(count):
            fill[sequence + k].append((offset, n))
    assert ranks == Counter(counts) and len(fill) == plan.sequences
    for parts in fill.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= limit
    return plan


def test_plans():
    rng = random.Random(4)
    assert check_plan({}).sequences == 0
    assert check_plan({1024: 3}).sequences == 3
    assert check_plan({512: 5}).sequences == 3
    assert check_plan({300: 1, 724: 1, 400: 1, 324: 1, 1: 1}, 1024).sequences == 2
    plan = check_plan({700: 4, 200: 4, 100: 4, 24: 4, 600: 1, 424: 1})
    assert plan.exact == plan.sequences == 5
    assert check_plan({256: 8}).exact == 2
    for _ in range(30):
        counts = Counter(min(1024, 1 + int(rng.expovariate(1 / rng.choice([50, 300, 600])))) for _ in range(3000))
        found, least = check_plan(counts).sequences, lower_bound([n for n, c in counts.items() for _ in range(c)])
        assert found <= 1.02 * least + 1
    # the plan is as large for a million times the pieces
    assert len(check_plan(counts).steps) < 20_000
    big = packing.Plan({n: c * 1_000_000 for n, c in counts.items()})
    assert len(big.steps) < 20_000 and sum(s[2] for s in big.steps) == 3_000_000_000
    with pytest.raises(ValueError, match="lengths"):
        packing.Plan({1025: 1})


def test_byte_pieces_match_the_library(rows):
    library = Tokenizer.from_file(BYTES)
    rng = random.Random(8)
    odd = [" ", " ", "　", "\x85", "\x1c", "\n", "\r\n", "  ", " ", "\t", "é", "ß", "東京", "🙂", "don't", "we'll", "3.5", "<|endoftext|>", "a", "Word", "!!", "...", "_", "́", "ﬁ"]
    texts = [r[1] for r in rows] + ["".join(rng.choice(odd) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    pieces = byte_pieces.BytePieces(BYTES)
    assert pieces.cuts
    for i in range(0, len(texts), 50):
        part = texts[i : i + 50]
        ids, at = pieces.encode(pa.array(part))
        for k, text in enumerate(part):
            assert ids[at[k] : at[k + 1]].tolist() == library.encode(text or "", add_special_tokens=False).ids, text


def expected_pieces(rows: list[tuple]) -> list[tuple]:
    library = Tokenizer.from_file(BYTES)
    out = []
    for doc, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            out.append((doc, k, a, b - a, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[a:b]))))
    return out


def check_packing(df, rows: list[tuple], same) -> None:
    found = [tuple(r) for r in df.collect()]
    expected = expected_pieces(rows)
    assert sorted((r[:5] for r in found), key=repr) == sorted(expected, key=repr)
    fill = defaultdict(list)
    for r in found:
        fill[r[5]].append((r[6], r[3]))
    for parts in fill.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1024
    assert len(fill) <= 1.03 * lower_bound([r[3] for r in expected]) + 1


def test_packing_query(spark, pairs, same):
    check_packing(catalog.op12_packing(spark, SF_DIR), pairs, same)


def test_packing_of_awkward_texts(spark, docs, none, rows, same):
    check_packing(packing.pack(docs, BYTES), [r[:2] for r in rows], same)
    assert packing.pack(none, BYTES).count() == 0
    with_ids = packing.pack(docs, BYTES, keep_ids=True).select("length", "ids", "ids_crc32").collect()
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in with_ids)


# ---------------------------------------------------------------- spelling


def test_near():
    words = ["", "a", "b", "ab", "ba", "abc", "acb", "abcd", "xbcd", "abd", "aab", "aabb"]
    for a in words:
        for b in words:
            assert spelling.near(a, b) == (a != b and abs(len(a) - len(b)) <= 1 and brute.one_edit(a, b)), (a, b)


def made_words(rng: random.Random, n: int, letters: str) -> dict[str, int]:
    count = {}
    for _ in range(n):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(7, 10)))
        for _ in range(rng.randint(1, 4)):
            count[word] = rng.choice([2, 3, 20, 30, 200, 2000])
            at = rng.randrange(len(word))
            word = rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice(letters) + word[at:], word[:at] + rng.choice(letters) + word[at + 1 :]])
    return count


def test_variants_over_many_buckets(spark, same, monkeypatch):
    """Small bounds, so that nodes split down to the full vector and leaves are dealt into parts."""
    monkeypatch.setattr(spelling, "LEAST", 8)
    count = made_words(random.Random(9), 300, "abqáÿ")
    count |= {"w" * 300: 50, "w" * 299: 3, "w" * 299 + "x": 2, "東京東京東京東": 9, "東京東京東京西": 100}
    df = spark.createDataFrame([*count.items(), (None, 5)], "word string, n long")
    same(spelling.variants(df), brute.variants(count), "word", "form", "root", "n", "n_near", "form_n")


def test_spelling_query(spark, pairs, same):
    columns = ("word", "form", "root", "n", "n_near", "form_n")
    same(catalog.op11_spelling(spark, SF_DIR), brute.variants(brute.spoiled_counts(pairs)), *columns)


def test_spelling_of_awkward_texts(spark, docs, none, rows, same):
    count = brute.spoiled_counts([r[:2] for r in rows])
    same(spelling.variants(spelling.word_counts(docs)), brute.variants(count), "word", "form", "root", "n", "n_near", "form_n")
    assert spelling.variants(spelling.word_counts(none)).count() == 0
