"""Documents with every awkward case in few rows."""

from __future__ import annotations

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

#: Columns that operators use inside; inputs may have them too.
CLASHING = ("key", "fp", "node", "cell", "row", "size", "target", "taken", "part", "bucket", "lang_pred", "score", "_lang_pred", "_mix_key", "n_words", "block", "template", "purity")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng: random.Random, n: int, words: str = "the of and river stone walks under every bright old house green light song") -> str:
    return " ".join(rng.choice(words.split()) + rng.choice(["", "", "s", "ing", "ed", "er"]) for _ in range(n))


def awkward() -> list[tuple]:
    rng = random.Random(3)
    passage = sentence(rng, 60)
    base = [sentence(rng, 80) for _ in range(6)]
    texts = [
        None, "", " \t\n\r ", "one", "Two WORDS", "1 2 3 .", "ÉTÉ Élan ñandú 東京 ß", base[0], base[0], base[0].upper(),
        base[1] + " " + passage, passage + "\n" + base[2], passage, "a " * 700, "\n".join([base[3]] * 4), base[3] + " tail",
        "x <|endoftext|> y<|endoftext|>", "tabs\tand\x0bvertical\x0cfeeds\r\nlines", "nb\u00a0sp \u2003 wide \x1c sep \x85 nel",
        "it's we'll I'd  double   spaces ", sentence(rng, 4000), "w" * 30_000, "%% ## $$ " * 40, base[4] + " " + base[4], base[5],
    ]
    langs = ["en", "fr", None]
    sources = ["b", "a", None, "B", "é"]
    rows = [(i, t, langs[i % 3], sources[i % 5], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[7], rows[12], (None, base[5], "en", None, 1), (None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return awkward()


@pytest.fixture(scope="session")
def docs(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit("clash") for c in CLASHING}).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def found(df, *columns) -> list[tuple]:
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


@pytest.fixture(scope="session")
def same():
    def check(df, expected, *columns):
        assert found(df, *columns) == sorted((tuple(x) for x in expected), key=repr)

    return check
