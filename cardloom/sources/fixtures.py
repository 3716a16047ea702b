"""The card, transaction and merchant tables as SQL views over the generated star schema.

Each text runs unchanged on Spark and on DuckDB: ``{name}`` is a base table.
``amount_units`` is the amount in whole ten-thousandths, so its sums and means
are exact in any order of addition.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from .tables import spread_small

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
        "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS = {
    "cards": """
SELECT c.c_custkey AS card_id, a.first_active_month,
       1 + c.c_nationkey % 5 AS feature_1, 1 + c.c_nationkey % 3 AS feature_2,
       CASE WHEN c.c_mktsegment < 'F' THEN 1 ELSE 0 END AS feature_3,
       c.c_acctbal AS target,
       CASE WHEN c.c_custkey % 5 = 0 THEN 'test' ELSE 'train' END AS split
FROM {customer} c LEFT JOIN (SELECT o_custkey, date_trunc('month', min(o_orderdate)) AS first_active_month
                             FROM {orders} GROUP BY o_custkey) a ON a.o_custkey = c.c_custkey""",
    "txn": """
SELECT o.o_custkey AS card_id,
       CASE WHEN p.p_size = 50 THEN NULL ELSE l.l_suppkey END AS merchant_id,
       p.p_brand AS merchant_category_id, p.p_type AS subsector_id,
       s.s_nationkey AS city_id, n.n_regionkey AS state_id,
       CASE WHEN l.l_returnflag = 'R' THEN 'N' ELSE 'Y' END AS authorized_flag,
       CASE WHEN l.l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS category_1,
       CASE WHEN p.p_size % 7 = 0 THEN NULL ELSE 1 + p.p_size % 5 END AS category_2,
       CASE WHEN l.l_linenumber = 7 THEN NULL WHEN l.l_returnflag = 'A' THEN 'A'
            WHEN l.l_returnflag = 'N' THEN 'B' ELSE 'C' END AS category_3,
       CASE l.l_linenumber WHEN 7 THEN 999 WHEN 6 THEN -1 ELSE l.l_linenumber - 1 END AS installments,
       CAST((year(l.l_shipdate) - 2001) * 12 + month(l.l_shipdate) - 1 AS INT) AS month_lag,
       l.l_extendedprice * (1 - l.l_discount) AS purchase_amount,
       CAST(round(l.l_extendedprice * (1 - l.l_discount) * 10000) AS DOUBLE) AS amount_units,
       l.l_shipdate AS purchase_date,
       l.l_orderkey AS ord_1, l.l_linenumber AS ord_2, l.l_partkey AS ord_3
FROM {lineitem} l JOIN {orders} o ON o.o_orderkey = l.l_orderkey
LEFT JOIN {part} p ON p.p_partkey = l.l_partkey
LEFT JOIN {supplier} s ON s.s_suppkey = l.l_suppkey
LEFT JOIN {nation} n ON n.n_nationkey = s.s_nationkey""",
    "merchants": """
SELECT s_suppkey AS merchant_id, s_nationkey AS city_id,
       CASE WHEN s_suppkey % 3 = 0 THEN 'A' WHEN s_suppkey % 3 = 1 THEN 'C' ELSE 'E' END AS most_recent_sales_range,
       CASE WHEN s_nationkey % 2 = 0 THEN 'B' ELSE 'D' END AS most_recent_purchases_range,
       CASE WHEN s_acctbal < 0 THEN 'N' ELSE 'Y' END AS category_4,
       CASE WHEN s_suppkey % 9 = 0 THEN CAST(NULL AS DOUBLE) ELSE s_acctbal END AS numerical_1,
       CASE WHEN s_suppkey % 10 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE s_acctbal / 3 END AS avg_purchases_lag3,
       s_acctbal / 6 AS avg_purchases_lag6
FROM {supplier}""",
}

# The total order of a card's transactions.
ROW_ORDER = ("purchase_date", "ord_1", "ord_2", "ord_3")


class Tables:
    """Lazy access to the base tables and the views of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def base(self, name: str) -> DataFrame:
        return spread_small(self.spark.read.parquet(f"{self.folder}/{name}.parquet"))

    def view(self, name: str) -> DataFrame:
        text = VIEWS[name]
        used = {b: self.base(b) for b in BASE if "{" + b + "}" in text}
        return self.spark.sql(text, **used)

    @cached_property
    def cards(self) -> DataFrame:
        return self.view("cards")

    @cached_property
    def txn(self) -> DataFrame:
        return self.view("txn")

    @cached_property
    def txn_sizes(self) -> DataFrame:
        """(card_id, _n): how many rows of ``txn`` the card's orders have, from the keys alone."""
        lines = self.base("lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("_n"))
        orders = self.base("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("card_id"))
        return orders.join(lines, "l_orderkey").select("card_id", "_n")

    @cached_property
    def merchants(self) -> DataFrame:
        return self.view("merchants")


def oracle_prefix(sql: str) -> str:
    """The view definitions that ``sql`` names, as a WITH list for DuckDB."""
    import re
    plain = {b: b for b in BASE}
    wanted = [v for v in VIEWS if re.search(rf"\b{v}\b", sql)]
    return ",\n".join(f"{v} AS ({VIEWS[v].format(**plain)})" for v in wanted)
