"""Tables of wide rows are made by code that the JVM compiles."""

from __future__ import annotations

import random

from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from sparsemat.llm import fuzzy_lines

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def test_tables_of_sketches_hold_methods_to_what_is_compiled(spark, monkeypatch):
    """The limit holds for their writes alone, and the result is right under it."""
    seen, write = [], DataFrameWriter.parquet

    def parquet(self, path, *args, **kwargs):
        seen.append((path, spark.conf.get(LIMIT)))
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    before = spark.conf.get(LIMIT)
    rng = random.Random(25)
    lines = [" ".join(f"w{rng.randrange(500)}" for _ in range(40)) for _ in range(20)]
    df = spark.createDataFrame([(i, x + end) for i, x in enumerate(lines) for end in ("", " tail")], "doc_id long, text string")
    assert fuzzy_lines.dedup_lines(df).agg(F.sum("n_removed")).first()[0] == 20
    for name in ("sketches", "candidates", "met", "dealt"):
        limits = [int(limit) for path, limit in seen if name in path.rsplit("/", 1)[-1]]
        assert limits and max(limits) <= 8000, (name, seen)
    assert spark.conf.get(LIMIT) == before
