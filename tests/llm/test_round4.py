"""Words that are walked in step."""

from __future__ import annotations

import random

import pyarrow as pa

from sparsemat.llm import langid


def test_words_are_walked_in_step(monkeypatch):
    """All automata, odd characters and ends of matches: as one word at a time; only long words are walked alone."""
    rng = random.Random(21)
    word = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    kinds = {"x": "abcdé", "y": "bcdeß\U00010428", "z": "東京语ab"}
    model = {k: langid.Automaton(" " + " ".join(word(letters, rng.randrange(1, 9)) for _ in range(300)) + " ") for k, letters in kinds.items()}
    words = [word("abcdeéß東京q\U00010428", rng.randrange(1, 20)) for _ in range(3000)] + ["", "a" * 63, "b" * 64, "ab" * 500]
    expected = [[a.phrases([32, *map(ord, w), 32]) for a in model.values()] for w in words]
    alone, phrases = [], langid.Automaton.phrases
    monkeypatch.setattr(langid.Automaton, "phrases", lambda self, codes: alone.append(len(codes)) or phrases(self, codes))
    monkeypatch.setattr(langid, "WALKS", 1000)
    assert langid.Walks(list(model.values())).phrases(words).tolist() == expected
    alone.clear()
    judge = langid.Judge(model)
    names, score = judge.texts(pa.array(["abc dé " + "éc" * 500, "東京 语", None, "1 2", "ß bcd"]))
    assert names == ["x", "z", langid.UNKNOWN, langid.UNKNOWN, "y"] and score[2] == score[3] == 0
    assert alone == [1002] * 3
    assert langid.Judge({}).texts(pa.array(["abc"]))[0] == [langid.UNKNOWN]
