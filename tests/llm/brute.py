"""Plain Python versions of the corpus operators' results, one text at a time."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import xxhash

PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fingerprint(text: str | None, k: int = 3) -> int:
    words = PLAIN.findall((text or "").translate(LOWER))
    grams = [words[i : i + k] for i in range(len(words) - k + 1)] or ([words] if words else [])
    h = [xxhash.xxh64_intdigest(" ".join(g).encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(prints: dict[int, int], bits: int = 3) -> dict[int, int]:
    """Smallest id reachable over fingerprints at most ``bits`` apart."""
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def contamination(docs: list[tuple], items: list[tuple]) -> list[tuple]:
    windows = defaultdict(set)
    for item, text in items:
        words = ALNUM.findall((text or "").translate(LOWER))
        n = min(13, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i : i + n])].add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words = ALNUM.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                names = windows.get(tuple(words[i : i + n]))
                if names:
                    hit |= set(range(i, i + n))
                    found |= names
        bad = len(hit) > 0 and 20 * len(hit) >= len(words)
        out.append((doc, len(words), len(hit), len(found), sha(",".join(sorted(found))), bad))
    return out


def without_repeats(docs: list[tuple], n: int = 13) -> list[tuple]:
    least: dict[tuple, float] = {}
    split = [(d, PLAIN.findall(t or "")) for d, t in docs]
    key = lambda d: float("inf") if d is None else d
    for doc, words in split:
        for i in range(len(words) - n + 1):
            w = tuple(words[i : i + n])
            least[w] = min(least.get(w, float("inf")), key(doc))
    out = []
    for doc, words in split:
        gone = set()
        for i in range(len(words) - n + 1):
            if least[tuple(words[i : i + n])] < key(doc):
                gone |= set(range(i, i + n))
        kept = [w for i, w in enumerate(words) if i not in gone]
        out.append((doc, len(words), len(gone), sha(" ".join(kept))))
    return out


def token_digests(docs: list[tuple], encode) -> list[tuple]:
    out, start = [], 0
    for doc, text in sorted(docs, key=lambda d: (d[0] is not None, d[0], d[1] is not None, (d[1] or "").encode())):
        ids = [*encode(text or ""), 1]
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        out.append((doc, start, len(ids), zlib.crc32(raw)))
        start += len(ids)
    return out


def base_statistics(doc, text: str | None) -> tuple:
    text = text or ""
    words = PLAIN.findall(text)
    lines = [x for x in text.split("\n") if PLAIN.search(x)]
    seen = defaultdict(list)
    for i in range(len(words) - 2):
        seen[tuple(words[i : i + 3])].append(i)
    repeated = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)}
    n = len(words)
    failed = n < 50 or 100 * len(repeated) > 50 * n
    symbols = sum(c in "#*$%&|<>" for c in text)
    return doc, n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), failed


RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))


def url_parts(url: str | None) -> tuple[str, str, str | None, str | None]:
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.translate(LOWER)
    best = None
    for verdict, rule in RULES:
        at, _, tail = rule.partition("/")
        if (host == at or host.endswith("." + at)) and path.startswith("/" + tail) and (best is None or len(rule) > len(best[1])):
            best = verdict, rule
    return host, path, best and best[1], best and best[0]


def planted(doc, text: str | None) -> list[str]:
    """The words of a text, every tenth text made periodic from some word on."""
    words = PLAIN.findall(text or "")
    h, n = zlib.crc32(str(doc).encode()), len(words)
    if doc is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def periodic_runs(words: list[str]) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of each run, every period tried at every word."""
    least: dict[tuple[int, int], int] = {}
    for p in range(len(words) // 4, 0, -1):
        i = 0
        while i < len(words) - p:
            j = i
            while j < len(words) - p and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(6, 4 * p):
                least[i, j + p] = p
            i = max(j, i + 1) if j > i else i + 1
    return sorted((s, e - s, p) for (s, e), p in least.items())


def run_digests(doc, words: list[str]) -> tuple:
    runs = periodic_runs(words)
    gone = {i for s, size, p in runs for i in range(s + p, s + size)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{size},{p}\n" for s, size, p in runs)
    return doc, len(runs), *top, sha(listed), sha(" ".join(w for i, w in enumerate(words) if i not in gone))


def spoiled_counts(docs: list[tuple]) -> dict[str, int]:
    count: dict[str, int] = defaultdict(int)
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            at = h % len(run)
            count[run if h % 31 else run[:at] + run[at + 1 :]] += 1
    return {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(count: dict[str, int]) -> list[tuple]:
    near = {w: [x for x in count if abs(len(x) - len(w)) <= 1 and one_edit(x, w)] for w in count}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-count[x], x), default=None)
        form[w] = best if best and count[best] >= 10 * count[w] else None
    out = []
    for w in count:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, count[w], len(near[w]), form[w] and count[form[w]]))
    return out
