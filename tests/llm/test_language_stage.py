"""Language identification where ids or labels are missing."""

from __future__ import annotations

from sparsemat.llm import langid

WORDS = {"en": "the house and the river are old but this green song walks on", "de": "das alte haus und der fluss sind nicht weit von hier aber schön"}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(n: int, doc, lang=lambda name, i: name) -> list[tuple]:
    out = []
    for i in range(n):
        name = ("en", "de")[i % 2]
        words = WORDS[name].split()
        text = " ".join(words[(i * 5 + j * 3) % len(words)] for j in range(12)) + f" {i}"
        out.append((doc(i), text, lang(name, i), None, None))
    return out


def test_null_ids_are_learned_from(spark):
    """3,000 labelled rows without an id, and copies of one of them without end."""
    rows = rows_of(3000, lambda i: None)
    rows += [rows[0]] * 500
    found = langid.languages(spark.createDataFrame(rows, SCHEMA)).groupBy("lang_pred", "held_out").count().collect()
    assert {r.lang_pred for r in found} == {"en", "de"} and not any(r.held_out for r in found)
    model = langid.fit(spark.createDataFrame(rows, SCHEMA))
    assert sorted(model) == ["de", "en"]


def test_without_labels_all_rows_stay(spark):
    docs = spark.createDataFrame([*rows_of(30, lambda i: i, lambda name, i: None), (99, None, None, None, None), (98, "1 2", None, None, None)], SCHEMA)
    assert sorted(langid.known_only(docs).collect(), key=repr) == sorted(docs.collect(), key=repr)


def test_predictions_fill_missing_labels(spark):
    rows = rows_of(300, lambda i: i, lambda name, i: None if i % 5 == 0 else name)
    docs = spark.createDataFrame([*rows, (1000, "123", "en", None, None), (1001, None, "de", None, None)], SCHEMA)
    kept = langid.known_only(docs)
    assert kept.columns == docs.columns
    truth = {i: ("en", "de")[i % 2] for i in range(300)}
    assert {r.doc_id: r.lang for r in kept.collect()} == truth
