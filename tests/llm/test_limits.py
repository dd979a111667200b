"""What operators leave on disk and what their shortcuts may not lose."""

from __future__ import annotations

import os
import random
from collections import Counter

import pyarrow as pa
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparsemat.llm import byte_pieces, catalog, common, decontaminate, fuzzy_lines, simhash, token_ids, tokenizer


def test_fuzzy_lines_keep_neither_sets_nor_shuffles(spark, monkeypatch):
    """What stays on disk is texts, sketches and keys; shuffle files go with the write that made them."""
    seen, keep = [], fuzzy_lines.materialize
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: sum("shuffle_" in str(x) for x in files.getAllBlocks().mkString("\n").split("\n"))

    def kept(df, name, *args, **kwargs):
        before = shuffles()
        out = keep(df, name, *args, **kwargs)
        seen.append((name, [t for _, t in df.dtypes if t.startswith(("array", "map", "binary"))], shuffles() - before))
        return out

    monkeypatch.setattr(fuzzy_lines, "materialize", kept)
    rng = random.Random(12)
    lines = [" ".join(f"w{rng.randrange(500)}" for _ in range(40)) for _ in range(30)]
    df = spark.createDataFrame([(i, x + end) for i, x in enumerate(lines) for end in ("", " tail")], "doc_id long, text string")
    assert fuzzy_lines.dedup_lines(df).agg(F.sum("n_removed")).first()[0] == 30
    assert seen and not any(lists for _, lists, _ in seen)
    assert all(more <= 0 for _, _, more in seen), seen


def test_sketches_let_all_alike_lines_pass(spark):
    rng = random.Random(13)
    lines = ["".join(rng.choice("abcd ") for _ in range(rng.choice((5, 30, 200, 900)))) for _ in range(40)]
    lines += [x[: len(x) - rng.randrange(len(x) // 6 + 1)] + rng.choice(("", "x", "yz")) for x in lines] + ["-" * 40, "-" * 900]
    df = spark.createDataFrame([(i, 0, x) for i, x in enumerate(lines)], "a long, b long, line string")
    rows = fuzzy_lines.sketched(df).join(df.select("a", fuzzy_lines.shingles(F.col("line")).alias("set")), "a").cache()
    one, two = (rows.select(*(F.col(c).alias(f"{c}{end}") for c in rows.columns)) for end in "12")
    pairs = one.join(two, F.col("a1") < F.col("a2")).select(fuzzy_lines._likely("1", "2").alias("likely"), fuzzy_lines._alike("set1", "set2").alias("alike"))
    found = {(r["likely"], r["alike"]): r["count"] for r in pairs.groupBy("likely", "alike").count().collect()}
    assert found.get((False, True), 0) == 0 and found[True, True] > 20 and found[False, False] > 1000


def test_documents_that_stay_are_not_shuffled(spark):
    """Nulls, shared ids and odd key types are kept or dropped as an anti-join does; the texts of what stays don't travel."""
    rng = random.Random(14)
    rows = [(i, rng.randbytes(2000).hex()) for i in range(600)] + [(None, "a"), (None, "b"), (3, "c"), (4, "d")]
    df = spark.createDataFrame(rows, "doc_id int, text string").repartition(4)
    df = common.materialize(df, "limits")
    gone = spark.createDataFrame([(3,), (5,), (1000,)], "doc_id long")
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    size = lambda: sum(os.path.getsize(x) for x in files.getAllFiles().mkString("\n").split("\n") if "shuffle_" in x)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = size()
        got = [tuple(r) for r in common.without(df, gone).collect()]
        assert size() - before < 600 * 2000 / 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert Counter(got) == Counter(r for r in rows if r[0] not in (3, 5))
    empty = gone.filter("doc_id < 0")
    assert common.without(df, empty).count() == len(rows) and common.without(df.filter("false"), gone).count() == 0


def test_stages_of_the_pipeline_do_not_shuffle_what_stays(spark):
    rng = random.Random(15)
    text = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(300))
    texts = [text() for _ in range(100)]
    rows = [(i, x) for i, x in enumerate(texts)] + [(200, texts[7]), (None, texts[8])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([("q", " ".join(texts[3].split()[:60]))], "item_id string, text string")
    for out, less in ((simhash.keep_one(df), {200}), (decontaminate.clean(df, bench), {3})):
        assert Counter(tuple(r) for r in out.collect()) == Counter(r for r in rows if r[0] not in less)
        assert "Union" in out._jdf.queryExecution().optimizedPlan().toString()


def test_pieces_met_again_are_not_encoded_again(monkeypatch):
    """Words that every slice holds stay known while the words around them change."""
    monkeypatch.setattr(byte_pieces, "REMEMBERED", 300)
    path = public_tokenizers.path(catalog.COUNTS)
    pieces, library = byte_pieces.BytePieces(path), Tokenizer.from_file(path)
    often = [f"common{i}" for i in range(50)]
    new: list[str] = []
    for name in ("_many", "_single"):
        monkeypatch.setattr(pieces, name, lambda part, f=getattr(pieces, name): (new.extend(part), f(part)))
    for k in range(8):
        texts = [" ".join([*often, *(f"only{k}x{i}" for i in range(200)), "a<|endoftext|>b", " nb sp"])]
        ids, at = pieces.encode(pa.array(texts))
        assert ids.tolist() == library.encode(texts[0], add_special_tokens=False).ids and at.tolist() == [0, len(ids)]
    assert sum(piece.strip() in often for piece in new) <= 2 * len(often)


def test_arrow_batches_of_kept_tables_are_bounded_by_bytes(spark):
    """A task takes texts in batches of ``SLICE_BYTES``, not of 10,000 rows; the session's setting stays."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    before = spark.conf.get(common._BATCH)
    long = spark.range(3000).coalesce(1).select(F.repeat(F.lit("words "), 700).alias("text"))
    got = [r["n"] for r in common.materialize(long.mapInArrow(sizes, "n long"), "batches").collect()]
    assert sum(got) > 12e6 and max(got) < 1.1 * common.SLICE_BYTES
    assert spark.conf.get(common._BATCH) == before


def test_token_files_encode_few_bytes_at_once(monkeypatch):
    seen = []

    class Counting(tokenizer.Chunks):
        def encode(self, column):
            seen.append(sum(len(x) for x in column.to_pylist()))
            return super().encode(column)

    chunks = Counting(public_tokenizers.path(catalog.IDS))
    monkeypatch.setattr(token_ids, "chunk_ids", lambda path: chunks)
    monkeypatch.setattr(token_ids.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(600)), "text": ["some words " * 600] * 600})
    blocks = list(token_ids._encoder("")(iter([batch])))
    assert sum(b.column("n_docs")[0].as_py() for b in blocks) == 600
    assert sum(seen) == 600 * 6600 and max(seen) <= token_ids.TEXT_BYTES


def test_fuzzy_lines_near_copies_of_a_line_meet_it_first(spark, monkeypatch):
    """Copies that are alike to their original, but not to each other, leave no pairs to the second step."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    base = [word() for _ in range(70)]
    texts = [" ".join(base)] + [" ".join(word() if i in (3 + k % 60, 66) else w for i, w in enumerate(base)) for k in range(60)]
    counts, keep = [], fuzzy_lines.materialize

    def kept(df, name, *args, **kwargs):
        out = keep(df, name, *args, **kwargs)
        if name == "candidates":
            counts.append((out.count(), out.select("a1", "b1", "a2", "b2").distinct().count()))
        return out

    monkeypatch.setattr(fuzzy_lines, "materialize", kept)
    monkeypatch.setattr(fuzzy_lines, "SIMILARITY", 0.84)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in fuzzy_lines.dedup_lines(df).collect()}
    first, second = counts
    assert got[0] == 0 and sum(got.values()) >= 55
    assert second[0] == second[1] and second[0] <= 0.1 * 60 * 59 / 2, counts
