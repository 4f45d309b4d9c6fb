"""Profiles, checksums, dataset comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.catalog.core import Catalog, table
from sluicework.operators import quality

CATALOG = Catalog()


def _entropy(name: str, source: str) -> str:
    return (f"SELECT 'Column' AS entity, '{name}' AS instance, 'Entropy' AS name, -sum(p * ln(p)) AS value FROM ("
            f"SELECT count(*) / sum(count(*)) OVER () AS p FROM {source} WHERE {name} IS NOT NULL GROUP BY {name})")


def _metrics(source: str) -> str:
    return f"""
      SELECT 'Dataset' AS entity, '*' AS instance, 'Size' AS name, CAST(count(*) AS DOUBLE) AS value FROM {source}
      UNION ALL SELECT 'Column', 'o_custkey', 'Completeness', CAST(count(o_custkey) AS DOUBLE) / count(*) FROM {source}
      UNION ALL SELECT 'Column', 'o_custkey', 'CountDistinct', CAST(count(DISTINCT o_custkey) AS DOUBLE) FROM {source}
      UNION ALL SELECT 'Column', 'o_totalprice', 'Minimum', min(o_totalprice) FROM {source}
      UNION ALL SELECT 'Column', 'o_totalprice', 'Mean', avg(o_totalprice) FROM {source}
      UNION ALL SELECT 'Column', 'o_totalprice', 'Maximum', max(o_totalprice) FROM {source}
      UNION ALL {_entropy('o_orderpriority', source)}
      UNION ALL {_entropy('o_custkey', source)}
    """


GAPPY = """(SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END AS o_custkey, o_totalprice,
  o_orderpriority FROM orders)"""


def gappy_orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_custkey")).alias("o_custkey"),
        "o_totalprice", "o_orderpriority")


def profile_orders(df: DataFrame) -> DataFrame:
    return quality.profile(df, ["o_custkey"], ["o_custkey"], ["o_totalprice"], ["o_orderpriority", "o_custkey"])


@CATALOG.query("profile_metrics", f"""
  SELECT entity, instance, name, round(value, 4) AS value FROM ({_metrics(GAPPY)})
""")
def profile_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Tidy metrics of named columns."""
    return profile_orders(gappy_orders(spark, folder)).withColumn("value", F.round("value", 4))


CHANGED = """(SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END AS o_custkey,
  CASE WHEN o_orderkey % 1000 = 0 THEN -1.0 ELSE o_totalprice END AS o_totalprice, o_orderpriority
  FROM orders WHERE o_orderkey % 10 <> 9)"""


@CATALOG.query("metric_diff", f"""
  SELECT entity, instance, name, round(value, 3) AS value, 'left' AS side FROM ({_metrics(GAPPY)}) l
  WHERE NOT EXISTS (SELECT 1 FROM ({_metrics(CHANGED)}) r
                    WHERE r.instance = l.instance AND r.name = l.name AND round(r.value, 3) = round(l.value, 3))
  UNION ALL
  SELECT entity, instance, name, round(value, 3), 'right' FROM ({_metrics(CHANGED)}) r
  WHERE NOT EXISTS (SELECT 1 FROM ({_metrics(GAPPY)}) l
                    WHERE r.instance = l.instance AND r.name = l.name AND round(r.value, 3) = round(l.value, 3))
""")
def metric_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics of a frame and a changed copy that do not agree."""
    orders = gappy_orders(spark, folder)
    changed = orders.filter("o_orderkey % 10 <> 9").withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") % 1000 == 0, -1.0).otherwise(F.col("o_totalprice")))
    return quality.metric_diff(profile_orders(orders), profile_orders(changed), digits=3)


@CATALOG.query("row_checksum", """
  SELECT c_custkey, md5(concat_ws('~', CAST(c_custkey AS VARCHAR), c_name,
           coalesce(CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_nationkey AS VARCHAR) END, chr(0)), c_mktsegment)) AS safe_md5,
         md5(concat_ws('~', CAST(c_custkey AS VARCHAR), c_name,
           CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_nationkey AS VARCHAR) END, c_mktsegment)) AS plain_md5
  FROM customer
""")
def row_checksum(spark: SparkSession, folder: str) -> DataFrame:
    """Null-safe and null-skipping row checksums."""
    rows = table(spark, folder, "customer").select(
        "c_custkey", "c_name", F.when(F.col("c_custkey") % 5 != 0, F.col("c_nationkey")).alias("c_nationkey"), "c_mktsegment")
    both = quality.row_checksum(rows, column="safe_md5")
    parts = [F.col(c).cast("string") for c in rows.columns]
    return both.withColumn("plain_md5", F.md5(F.concat_ws("~", *parts))).select("c_custkey", "safe_md5", "plain_md5")


# Prices as decimals, whose text is the same in every engine.
LINES = """(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS DECIMAL(18,2)) AS l_quantity,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS l_extendedprice, CAST(l_discount AS DECIMAL(18,2)) AS l_discount,
  CAST(l_tax AS DECIMAL(18,2)) AS l_tax, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem)"""
LINE_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                "l_returnflag", "l_linestatus", "l_shipdate")


def _changed_lines(dropped: int, changed: int, twice: int) -> str:
    return f"""
      WITH l AS (SELECT * FROM {LINES}),
           r AS (SELECT * REPLACE (CASE WHEN l_orderkey % {changed} = 0 THEN -1 ELSE l_partkey END AS l_partkey)
                 FROM l WHERE l_orderkey % {dropped} <> 0 UNION ALL SELECT * FROM l WHERE l_orderkey % {twice} = 1)
      SELECT md5(concat_ws('~', {', '.join(LINE_COLUMNS)})) AS md5,
             CASE WHEN sum(s) > 0 THEN 'left' ELSE 'right' END AS side, CAST(abs(sum(s)) AS BIGINT) AS copies
      FROM (SELECT *, 1 AS s FROM l UNION ALL SELECT *, -1 FROM r) u GROUP BY {', '.join(LINE_COLUMNS)} HAVING sum(s) <> 0"""


def changed_lines(spark: SparkSession, folder: str, dropped: int, changed: int, twice: int) -> tuple[DataFrame, DataFrame]:
    money = {"l_quantity", "l_extendedprice", "l_discount", "l_tax"}
    kinds = dict.fromkeys(money, "decimal(18,2)") | {"l_shipdate": "date"}
    left = table(spark, folder, "lineitem").select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in LINE_COLUMNS])
    part = F.when(F.col("l_orderkey") % changed == 0, F.lit(-1)).otherwise(F.col("l_partkey")).cast(left.schema["l_partkey"].dataType)
    return left, left.filter(f"l_orderkey % {dropped} <> 0").withColumn("l_partkey", part).unionByName(
        left.filter(f"l_orderkey % {twice} = 1"))


@CATALOG.query("dataset_diff", _changed_lines(77, 100, 91))
def dataset_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of either side that the other lacks, repeats counted."""
    return quality.dataset_diff(*changed_lines(spark, folder, 77, 100, 91))


@CATALOG.query("digest_diff", _changed_lines(1201, 1501, 1301))
def digest_diff(spark: SparkSession, folder: str) -> DataFrame:
    """The same by digests of key ranges; only rows of differing ranges are compared."""
    return quality.digest_diff(*changed_lines(spark, folder, 1201, 1501, 1301), keys=["l_orderkey"])


@CATALOG.query("missing_rows", """
  SELECT DISTINCT md5(concat_ws('~', o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)),
    CAST(o_orderdate AS DATE), o_orderpriority)) AS md5 FROM orders WHERE o_orderkey % 77 = 0
""")
def missing_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Left anti join on the checksum."""
    rows = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)"),
        F.col("o_orderdate").cast("date"), "o_orderpriority")
    return quality.missing_checksums(rows, rows.filter("o_orderkey % 77 <> 0"))


def _hints(name: str, numeric: bool) -> str:
    rules = [
        f"CASE WHEN count({name}) = count(*) THEN 'complete' END",
        f"CASE WHEN count({name}) = count(*) AND count(DISTINCT {name}) = count(*) THEN 'unique' END",
        f"CASE WHEN count(DISTINCT {name}) <= 10 THEN 'small_domain' END",
    ]
    if numeric:
        rules.append(f"CASE WHEN min({name}) >= 0 THEN 'non_negative' END")
    return f"SELECT '{name}' AS column_name, unnest([{', '.join(rules)}]) AS rule FROM supplier"


@CATALOG.query("constraint_hints", f"""
  SELECT column_name, rule FROM (
    {_hints('s_suppkey', True)} UNION ALL {_hints('s_name', False)} UNION ALL
    {_hints('s_nationkey', True)} UNION ALL {_hints('s_acctbal', True)}) WHERE rule IS NOT NULL
""")
def constraint_hints(spark: SparkSession, folder: str) -> DataFrame:
    """Rules a profile suggests."""
    return quality.suggest_constraints(table(spark, folder, "supplier"))


@CATALOG.query("dataset_diff_separators", """
  SELECT side, CAST(count(*) AS BIGINT) AS n FROM orders, (SELECT unnest(['left', 'right']) AS side) s GROUP BY side
""")
def dataset_diff_separators(spark: SparkSession, folder: str) -> DataFrame:
    """Values that hold the separator of the checksum do not run into each other."""
    orders = table(spark, folder, "orders")
    left = orders.select("o_orderkey", F.concat("o_orderstatus", F.lit("~")).alias("a"), F.col("o_orderpriority").alias("b"))
    right = orders.select("o_orderkey", F.col("o_orderstatus").alias("a"), F.concat(F.lit("~"), "o_orderpriority").alias("b"))
    return quality.dataset_diff(left, right).groupBy("side").agg(F.count(F.lit(1)).alias("n"))
