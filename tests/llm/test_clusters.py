"""Clusters that meet before all their pairs do."""

from __future__ import annotations

import random

from sparsemat.llm import fuzzy_lines


def test_clusters_meet_before_all_their_pairs(spark, monkeypatch):
    """Of alike lines that the first step leaves apart, few pairs are left to the second."""
    rng = random.Random(22)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    base = [word() for _ in range(70)]
    texts = [" ".join(word() if i == k else w for i, w in enumerate(base)) for k in range(60)]
    counts, keep, connect, calls = [], fuzzy_lines.materialize, fuzzy_lines.components, []

    def kept(df, name, *args, **kwargs):
        out = keep(df, name, *args, **kwargs)
        if name == "candidates":
            counts.append(out.count())
        return out

    def connected(edges, *args):
        calls.append(1)
        return connect(edges.filter("false") if len(calls) == 1 else edges, *args)

    monkeypatch.setattr(fuzzy_lines, "materialize", kept)
    monkeypatch.setattr(fuzzy_lines, "components", connected)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in fuzzy_lines.dedup_lines(df).collect()}
    assert got == {i: int(i > 0) for i in range(60)}
    assert len(counts) == 2 and counts[1] <= 60, counts
