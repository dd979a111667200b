"""Ids of a byte-level vocabulary, piece by piece where that gives what the library gives for the whole."""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import pyarrow as pa

from .common import SPACE, ranges, string_buffers
from .tokenizer import _ALNUM, _SIGN, load

#: Pieces whose ids a task remembers before it begins to forget those not met again.
REMEMBERED = 50_000

#: The byte-level alphabet's letter for a blank (fixed by that format).
_BLANK = "Ġ"

#: A blank and then no white space at all.
_ONE_BLANK = re.compile(r" \S+").fullmatch

#: Bytes that surely are no white space by themselves: ASCII without blanks and separators.
_SOLID = np.zeros(256, bool)
_SOLID[0x21:0x7F] = True

#: Lead bytes of two-byte characters, none of them white space.
_LEAD = np.zeros(256, bool)
_LEAD[0xC3:0xE0] = True


class BytePieces:
    """A byte-level tokenizer without normalizer that splits by the usual pattern.

    A pre-token never goes on from something else into white space, so a blank after a
    character that is none begins a piece; and a sign after an ASCII letter or digit does.
    A piece of one blank and no other white space has the blank's letter in its first token
    only: such pieces are encoded many at a time and told apart by that. A file with other
    settings has its texts encoded whole.
    """

    def __init__(self, path: str):
        self.tokenizer = load(path)
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        before = file["pre_tokenizer"] or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        added = file["added_tokens"]
        plain = plain and not file["normalizer"] and file["model"]["type"] == "BPE"
        plain = plain and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added)
        # cuts must not fall into a special token
        self.cuts = plain and not any(any(c.isspace() or c in ".,;:!?" for c in t["content"]) for t in added)
        self.special = [t["content"] for t in added]
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.first = np.zeros(max(vocab.values()) + 1, bool)
        self.first[[i for t, i in vocab.items() if t.startswith(_BLANK)]] = True
        self.seen: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _single(self, pieces: list[str]) -> None:
        for i in range(0, len(pieces), 10_000):
            part = pieces[i : i + 10_000]
            for piece, got in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.seen[piece] = np.array(got.ids, np.uint32).tobytes()

    def _many(self, pieces: list[str]) -> None:
        for i in range(0, len(pieces), 1000):
            part = pieces[i : i + 1000]
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            start = np.flatnonzero(self.first[ids])
            if len(start) != len(part) or start[0]:
                self._single(part)
                continue
            raw, at = ids.tobytes(), [*(4 * start).tolist(), 4 * len(ids)]
            for piece, a, b in zip(part, at, at[1:], strict=False):
                self.seen[piece] = raw[a:b]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        # two generations: what isn't met again while the next one fills is forgotten
        if len(self.seen) > REMEMBERED:
            self.before, self.seen = self.seen, {}
        found = list(map(self.seen.get, pieces))
        missed = [i for i, ids in enumerate(found) if ids is None]
        lost = [pieces[i] for i in missed]
        again = list(map(self.before.get, lost))
        self.seen.update([(piece, ids) for piece, ids in zip(lost, again, strict=True) if ids is not None])
        together, alone = [], []
        for piece, ids in zip(lost, again, strict=True):
            if ids is None:
                (together if _ONE_BLANK(piece) else alone).append(piece)
        joined = "".join(together)
        if any(special in joined for special in self.special):
            alone += [piece for piece in together if any(special in piece for special in self.special)]
            together = [piece for piece in together if not any(special in piece for special in self.special)]
        self._many(together)
        self._single(alone)
        for i in missed:
            found[i] = self.seen[pieces[i]]
        return found

    def _cut(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where pieces start, texts' own starts included."""
        start = np.zeros(len(data) + 1, bool)
        if self.cuts and len(data) > 1:
            solid = _SOLID[data[:-1]]
            solid[1:] |= _LEAD[data[:-2]]  # the second byte of such a character
            start[1:-1] = (SPACE[data[1:]] & solid) | (_SIGN[data[1:]] & _ALNUM[data[:-1]])
        start[at] = True
        start[len(data)] = False
        return np.flatnonzero(start)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and the n+1 places where texts begin; null is empty."""
        data, at = string_buffers(column)
        start = self._cut(data, at)
        offsets = np.append(start, len(data)).astype(np.int64)
        flat = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))
        encoded = flat.dictionary_encode()
        index = encoded.indices.to_numpy(zero_copy_only=False)
        known = self._pieces(encoded.dictionary.to_numpy(zero_copy_only=False).tolist())
        count = np.array([len(x) // 4 for x in known], np.int64)
        ids = np.frombuffer(b"".join(known), np.uint32)
        first = np.cumsum(count) - count
        per = count[index]
        total = np.concatenate([[0], np.cumsum(per)])
        return ids[ranges(first[index], per)], total[np.searchsorted(start, at)]


@functools.lru_cache(maxsize=2)
def byte_pieces(path: str) -> BytePieces:
    return BytePieces(path)
