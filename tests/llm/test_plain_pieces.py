"""Words of small Latin letters pass neither normalizer nor pattern."""

from __future__ import annotations

import random

import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

from sparsemat.llm import catalog, tokenizer


def test_plain_words_skip_normalizer_and_pattern():
    path = public_tokenizers.path(catalog.IDS)
    chunks, whole = tokenizer.Chunks(path), Tokenizer.from_file(path)
    letters = [chr(c) for c in (*range(0x61, 0x7B), 0xAA, 0xB5, 0xBA, *range(0xC0, 0x100))] + ["ı", "ſ", "é", "A", "'s", "9", "-", "東"]
    rng = random.Random(23)
    words = ["".join(rng.choice(letters if i % 2 else letters[:26]) for _ in range(rng.randrange(1, 14))) for i in range(4000)]
    words += [x for x in letters] + ["it's", "x<|endoftext|>y", "ééé", "ß", "÷"]
    texts = [" ".join(words[i : i + 50]) for i in range(0, len(words), 50)] + [None, ""]
    seen = []
    encode = chunks._many
    chunks._many = lambda pieces, by: seen.append((by is chunks.plain, len(pieces))) or encode(pieces, by)
    for _ in range(2):  # the second time all are remembered
        ids, at = chunks.encode(pa.array(texts[:-3]))
        for i, text in enumerate(texts[:-3]):
            assert ids[at[i] : at[i + 1]].tolist() == whole.encode(text, add_special_tokens=False).ids
    ids, at = chunks.encode(pa.array(texts[-3:]))
    assert ids.tolist() == whole.encode(texts[-3], add_special_tokens=False).ids and at[1:].tolist() == [len(ids)] * 3
    assert sum(n for plain, n in seen if plain) >= 1900
    assert chunks.plain.normalizer is None or "Lowercase" not in repr(chunks.plain.normalizer)
