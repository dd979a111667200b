"""Encoding texts piece by piece where that gives what the library gives for the whole."""

from __future__ import annotations

import functools
import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from tokenizers import normalizers, pre_tokenizers

from .common import PLAIN, Words, ranges, string_buffers

#: Pieces whose ids a task remembers before it begins to forget those not met again.
REMEMBERED = 150_000


def load(path: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


#: ASCII letters and digits, and signs that end a piece when they follow one: neither the apostrophe,
#: which may belong to the letters after it, nor what special tokens have.
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_SIGN = np.zeros(256, bool)
_SIGN[list(b'.,;:!?#$%&*+-/=@_()[]{}"')] = True


def _unsplit(path: str, file: dict):
    """The tokenizer for words of small Latin letters, spelled by ``_SPELLED``, between single blanks; None if they might need normalizer or pattern."""
    steps = [x["type"] for x in (file["normalizer"] or {}).get("normalizers", [{"type": None}])]
    split, *rest = (file["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    letters = split.get("type") == "Split" and r"|[\p{L}]+|" in split["pattern"].get("Regex", "")
    if not letters or [x["type"] for x in rest] != ["ByteLevel"] or not set(steps) <= {"NFC", "Replace", "Lowercase"}:
        return None
    own = load(path)
    own.normalizer = normalizers.Sequence([])
    own.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    return own


#: Small Latin letters that no normalizer changes.
_PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+").fullmatch

#: What the byte level makes of those beyond ASCII; it leaves the others as they are.
_LEVEL = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
_SPELLED = {c: _LEVEL.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xDF, 0x100)) if _PLAIN(c)}


class Chunks:
    """A lower-casing tokenizer that drops white space and never looks across it, piece by piece.

    White space ends a piece, and so does a sign after an ASCII letter or digit, where the
    split before the merges always cuts. Pieces are lower-cased (A-Z) unless the text may
    hold a special token. The last token of a pre-token ends with the vocabulary's mark for
    word ends, so pieces of letters alone, a pre-token each, are encoded many at a time and
    told apart by that mark; small Latin letters even without normalizer, pattern and byte level.
    """

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.seen: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        mark = file["model"]["end_of_word_suffix"]
        self.plain = _unsplit(path, file)
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if t.endswith(mark)]] = True

    def _single(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and how many each piece has."""
        got = [x.ids for i in range(0, len(pieces), 10_000) for x in self.tokenizer.encode_batch_fast(pieces[i : i + 10_000], add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(got), np.uint32), np.fromiter(map(len, got), np.int64, len(got))

    def _many(self, pieces: list[str], tokenizer) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of letters. Each has a pre-token or more; as many ends as pieces mean one each."""
        flat, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for i in range(0, len(pieces), 200):
            part = pieces[i : i + 200]
            text = " ".join(part)
            if tokenizer is self.plain and not text.isascii():
                for letter, spelled in _SPELLED.items():  # none of which has such a letter
                    text = text.replace(letter, spelled)
            ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            end = np.flatnonzero(self.ends[ids]) + 1
            if len(end) == len(part) and end[-1] == len(ids):
                own = np.diff(end, prepend=0)
            else:
                ids, own = self._single(part)
            flat.append(ids)
            counts.append(own)
        return np.concatenate(flat), np.concatenate(counts)

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct pieces, and where each one's begin and how many there are."""
        # two generations: what isn't met again while the next one fills is forgotten
        if len(self.seen) > REMEMBERED:
            self.before, self.seen = self.seen, {}
        found = list(map(self.seen.get, pieces))
        missed = [i for i, ids in enumerate(found) if ids is None]
        again = map(self.before.get, [pieces[i] for i in missed])
        plain, letters, other = [], [], []
        for i, ids in zip(missed, again, strict=True):
            piece = pieces[i]
            if ids is not None:
                found[i] = self.seen[piece] = ids
            elif self.plain is not None and _PLAIN(piece):
                plain.append(i)
            elif piece.isalpha():
                letters.append(i)
            else:
                other.append(i)
        new = plain + letters + other
        words = [pieces[i] for i in new]
        ways = [self._many(words[: len(plain)], self.plain), self._many(words[len(plain) : len(new) - len(other)], self.tokenizer), self._single(words[len(new) - len(other) :])]
        ids, own = (np.concatenate(x) for x in zip(*ways, strict=True))
        raw, end = ids.tobytes(), (4 * np.cumsum(own)).tolist()
        made = [raw[x:y] for x, y in zip([0, *end], end, strict=False)]
        self.seen.update(zip(words, made, strict=True))
        for i, x in zip(new, made, strict=True):
            found[i] = x
        count = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return np.frombuffer(b"".join(found), np.uint32), np.cumsum(count) - count, count

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and the n+1 places where texts begin."""
        data, at = string_buffers(column)
        cut = _SIGN[data]
        cut[1:] &= _ALNUM[data[:-1]]
        cut[:1] = False
        words = Words(data, at, PLAIN, lower=b"<|" not in data.tobytes(), cut=cut)
        lens = words.end - words.start
        offsets = np.concatenate([[0], np.cumsum(lens)])
        own = np.ascontiguousarray(words.data[words.mask])
        flat = pa.LargeStringArray.from_buffers(len(lens), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(own))
        encoded = flat.dictionary_encode()
        index = encoded.indices.to_numpy(zero_copy_only=False)
        pieces = encoded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids, first, count = self._pieces(pieces)
        per = count[index]
        total = np.concatenate([[0], np.cumsum(per)])
        return ids[ranges(first[index], per)], total[words.of]


@functools.lru_cache(maxsize=2)
def chunk_ids(path: str) -> Chunks:
    return Chunks(path)
