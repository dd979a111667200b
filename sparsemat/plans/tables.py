"""Matrices read out of the test tables, and the SQL that says the same.

Table ids start at 0 and matrix indices at 1, hence the ``+ 1``. Every matrix is an
aggregate, so its cells are unique and products may pass ``duplicates="unique"``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sum(df: DataFrame, keys: dict, value) -> DataFrame:
    keyed = df.select(*(F.expr(e).cast("bigint").alias(n) for n, e in keys.items()), value.alias("v"))
    return keyed.groupBy(*keys).agg(F.sum("v").alias("v"))


def _quantity():
    return F.col("l_quantity").cast("bigint")


def _one():
    return F.lit(1).cast("bigint")


def raw_cells(spark, sf_dir):
    """Supplier x part x quantity as it stands in the lines: pairs repeat."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") + 1).alias("i"), (F.col("l_partkey") + 1).alias("k"), _quantity().alias("v")
    )


def supplier_part(spark, sf_dir):
    """Quantity each supplier sold of each part."""
    return _sum(
        table(spark, sf_dir, "lineitem"), {"i": "l_suppkey + 1", "k": "l_partkey + 1"}, _quantity()
    )


def signed(a):
    """The same cells with alternating signs, so that products can cancel."""
    sign = F.when(F.pmod(F.col("i") + F.col("k"), F.lit(2)) == 0, 1).otherwise(-1)
    return a.withColumn("v", F.col("v") * sign)


def part_line(spark, sf_dir):
    """How often each part stands at each line number."""
    return _sum(table(spark, sf_dir, "lineitem"), {"k": "l_partkey + 1", "j": "l_linenumber"}, _one())


def supplier_order(spark, sf_dir):
    """Quantity each supplier delivered to each order."""
    return _sum(
        table(spark, sf_dir, "lineitem"), {"i": "l_suppkey + 1", "k": "l_orderkey + 1"}, _quantity()
    )


def order_customer(spark, sf_dir):
    """Which customer placed an order; orders without lines are there too."""
    return _sum(table(spark, sf_dir, "orders"), {"k": "o_orderkey + 1", "j": "o_custkey + 1"}, _one())


def order_part(spark, sf_dir):
    """Quantity of each part in each order."""
    return _sum(
        table(spark, sf_dir, "lineitem"), {"i": "l_orderkey + 1", "k": "l_partkey + 1"}, _quantity()
    )


def customer_priority(spark, sf_dir):
    """Orders per customer and priority. Customers get odd numbers only, so that with parts
    as the other side both have indices that the other one lacks."""
    return _sum(
        table(spark, sf_dir, "orders"),
        {"k": "2 * o_custkey + 1", "j": "substring(o_orderpriority, 1, 1)"},
        _one(),
    )


_HOT = "CASE WHEN l_linenumber <= 2 THEN 1 ELSE l_partkey + 1 END"


def order_hot(spark, sf_dir):
    """Order x part with nearly a third of all lines moved to k = 1."""
    return _sum(table(spark, sf_dir, "lineitem"), {"i": "l_orderkey + 1", "k": _HOT}, _quantity())


def hot_month(spark, sf_dir):
    """Part x month of shipment, with the same lines moved to k = 1."""
    return _sum(table(spark, sf_dir, "lineitem"), {"k": _HOT, "j": "month(l_shipdate)"}, _one())


def part_count(spark, sf_dir):
    return table(spark, sf_dir, "part").count()


def _cte(keys: dict, value: str, source: str) -> str:
    selected = ", ".join(f"CAST({e} AS BIGINT) AS {n}" for n, e in keys.items())
    places = ", ".join(str(n + 1) for n in range(len(keys)))
    return f"(SELECT {selected}, CAST(SUM({value}) AS BIGINT) AS v FROM {source} GROUP BY {places})"


_QTY = "CAST(l_quantity AS BIGINT)"

SQL = {
    "raw": f"(SELECT l_suppkey + 1 AS i, l_partkey + 1 AS k, {_QTY} AS v FROM lineitem)",
    "supplier_part": _cte({"i": "l_suppkey + 1", "k": "l_partkey + 1"}, _QTY, "lineitem"),
    "part_line": _cte({"k": "l_partkey + 1", "j": "l_linenumber"}, "1", "lineitem"),
    "supplier_order": _cte({"i": "l_suppkey + 1", "k": "l_orderkey + 1"}, _QTY, "lineitem"),
    "order_customer": _cte({"k": "o_orderkey + 1", "j": "o_custkey + 1"}, "1", "orders"),
    "order_part": _cte({"i": "l_orderkey + 1", "k": "l_partkey + 1"}, _QTY, "lineitem"),
    "customer_priority": _cte(
        {"k": "2 * o_custkey + 1", "j": "substring(o_orderpriority, 1, 1)"}, "1", "orders"
    ),
    "order_hot": _cte({"i": "l_orderkey + 1", "k": _HOT}, _QTY, "lineitem"),
    "hot_month": _cte({"k": _HOT, "j": "month(l_shipdate)"}, "1", "lineitem"),
}
SQL["signed"] = (
    "(SELECT i, k, v * CASE WHEN (i + k) % 2 = 0 THEN 1 ELSE -1 END AS v "
    f"FROM {SQL['supplier_part']} s)"
)
