"""Where queries that go through files put them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..sources.writers import shuffles_go


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that ``spark.checkpoint.dir`` names.

    Only a single-machine session (tests) may do without the setting; there a temporary
    folder serves, which executors on other machines could not see.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="sparsemat-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """`df` written to a fresh path and read back; what it shuffled is gone by then."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    with shuffles_go(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
