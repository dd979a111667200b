"""Signs end pieces, and words of small Latin letters pass the merges alone."""

from __future__ import annotations

import random

import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

from sparsemat.llm import catalog, tokenizer


def test_words_before_signs_are_encoded_many_at_a_time():
    path = public_tokenizers.path(catalog.IDS)
    chunks, whole = tokenizer.Chunks(path), Tokenizer.from_file(path)
    rng = random.Random(24)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzäöüßéñçÿ") for _ in range(rng.randrange(1, 12)))
    signs = [chr(c) for c in (*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F))]
    signs += ["###", "&&&", "$$$", "=\u0338", "-\u0301", "'s", "'ll", "<|endoftext|>", "|>", "_"]
    texts = [" ".join(word() + (rng.choice(signs) if i % 2 else rng.choice("#&$") * 3) + rng.choice(("", word(), "7", "A")) for i in range(60)) for _ in range(60)]
    for part in (texts, ["ab### cd&&& " * 3, "x=\u0338y a_b A-B 3+4 don't 'tis", None]):
        ids, at = chunks.encode(pa.array(part))
        for i, text in enumerate(part):
            assert ids[at[i] : at[i + 1]].tolist() == whole.encode(text or "", add_special_tokens=False).ids, text
    alone, single = [], chunks._single
    chunks._single = lambda pieces: alone.extend(pieces) or single(pieces)
    texts = [" ".join(f"{word()}a{sign}" for sign in "#*$%&" * 10) for _ in range(20)]
    ids, at = chunks.encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == whole.encode(text, add_special_tokens=False).ids
    assert len(alone) <= 5, alone  # the signs themselves at most
    assert "ByteLevel" not in repr(chunks.plain.pre_tokenizer)
