"""The registered corpus queries on the smallest tables, and the pipeline stage by stage."""

from __future__ import annotations

import brute
import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from sparsemat.llm import catalog
from sparsemat.llm.common import materialize

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pairs(spark):
    return [tuple(r) for r in catalog.table(spark, SF_DIR, "documents").select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_sql(spark, name, same):
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    cursor = db.execute(catalog.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    df = catalog.queries()[name](spark, SF_DIR)
    assert sorted(df.columns) == sorted(columns)
    same(df, cursor.fetchall(), *columns)


def test_simhash_query(spark, pairs, same):
    prints = {d: brute.fingerprint(t) for d, t in pairs}
    group = brute.groups(prints)
    same(catalog.op1_simhash(spark, SF_DIR), [(d, f"{p:016x}", group[d]) for d, p in prints.items()])


def test_pipeline(spark, pairs, same):
    docs = catalog.table(spark, SF_DIR, "documents")
    texts, kept = dict(pairs), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        if k < 4:
            assert out.columns == docs.columns, name
            out = materialize(out, name)
            kept.append({r[0] for r in out.select("doc_id").collect()})
        docs = docs if k == 4 else out
    letters = {d for d, t in pairs if t and any(c.isalpha() for c in t)}
    assert kept[0] == letters
    group = brute.groups({d: brute.fingerprint(texts[d]) for d in letters})
    assert kept[1] == {d for d in letters if group[d] == d}
    items = [tuple(r) for r in catalog.table(spark, SF_DIR, "benchmark").collect()]
    assert kept[2] == {r[0] for r in brute.contamination([(d, texts[d]) for d in sorted(kept[1])], items) if not r[5]}
    assert kept[3] <= kept[2]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(catalog.IDS))
    mixed = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    same(out, brute.token_digests(mixed, lambda t: tokenizer.encode(t, add_special_tokens=False).ids))
