"""What queries in several steps leave on the disk meanwhile."""

from __future__ import annotations

import re

import sparsemat as sm
from sparsemat.plans import catalog
from test_plans import SF_DIR, plan
from test_sizes import cells
from test_stored import as_dict, product


def test_a_change_is_dealt_out_once(spark, tmp_path, monkeypatch):
    """Stored products and the change travel to the task that sums and writes them, in one exchange."""
    path = str(tmp_path / "store")
    a, b = cells(spark, 900, "i", "k", 60, 64, 71), cells(spark, 900, "k", "j", 64, 60, 72)
    da = cells(spark, 100, "i", "k", 60, 64, 73)
    sm.write_partials(sm.partial_products(a, b), path, 16)
    written, saved = [], type(a.write).partitionBy
    monkeypatch.setattr(type(a.write), "partitionBy", lambda self, *c: written.append(plan(self._df, "simple")) or saved(self, *c))
    sm.update_partials(spark, path, 16, a, b, da, b.limit(0))
    above = written[0][: written[0].index("Union")]
    assert len(re.findall("Exchange|rebalance", above)) == 1 and "passthrough" in above
    new_a = a.unionByName(da).groupBy("i", "k").sum("v").toDF("i", "k", "v")
    assert as_dict(sm.merge_partials(sm.read_partials(spark, path))) == product(new_a, b)


def test_products_are_sized_one_after_the_other(spark):
    """The shuffle files of each product are gone before the next one is computed."""
    found = catalog.product_sizes(spark, SF_DIR)
    assert "Exchange" not in plan(found, "simple") and found.count() == 5


def test_stores_leave_no_shuffle_files(spark, tmp_path):
    tracker = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    before = set(spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(tracker.shuffleStatuses().keySet()))
    a, b = cells(spark, 900, "i", "k", 60, 64, 74), cells(spark, 900, "k", "j", 64, 60, 75)
    sm.write_partials(sm.partial_products(a, b, skew="salt"), str(tmp_path / "store"), 16)
    after = set(spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(tracker.shuffleStatuses().keySet()))
    assert after <= before
