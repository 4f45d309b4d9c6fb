"""Specs run end to end, and plain Spark SQL through the runner."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.catalog.core import Catalog, file_input, spec_document, table
from sluicework.plans.backfill import missing_days
from sluicework.plans.hooks import hook
from sluicework.plans.runner import run_pipeline
from sluicework.plans.spec import load_pipeline, run_variables
from sluicework.session import shared_dir

CATALOG = Catalog()

DISCARD = [{"query": "select * from #process", "action": "noop"}]


@hook("catalog.large_orders")
def large_orders(df: DataFrame) -> DataFrame:
    return df.filter(F.col("o_totalprice") > 250000)


def through_spec(
    spark: SparkSession, name: str, inputs: list, query: str, variables: dict | None = None, **extra,
) -> DataFrame:
    """Result frame of a spec, without running its outputs."""
    spec = load_pipeline(spec_document(name, inputs, query, DISCARD, **extra), name)
    return run_pipeline(spark, spec, variables=variables, write=False).frame


SEGMENT_REVENUE = """
  SELECT n.n_name, c.c_mktsegment, CAST(count(*) AS BIGINT) AS order_count,
         CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY n.n_name, c.c_mktsegment
"""


@CATALOG.query("spec_join", SEGMENT_REVENUE)
def spec_join(spark: SparkSession, folder: str) -> DataFrame:
    """Three file inputs, one SQL join, one file output read back."""
    target = shared_dir(spark, "spec-join")
    outputs = [{"query": "select * from #process", "action_class": "WriteToFile", "format": "parquet",
                "output_location": target, "mode": "overwrite"}]
    inputs = [file_input(folder, name) for name in ("orders", "customer", "nation")]
    spec = load_pipeline(spec_document("segment_revenue", inputs, SEGMENT_REVENUE, outputs), "segment_revenue")
    run_pipeline(spark, spec)
    return spark.read.parquet(target)


@CATALOG.query("spec_two_outputs", """
  SELECT 'status' AS part, o_orderstatus AS label, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 2
  UNION ALL
  SELECT 'segment', c_mktsegment, CAST(count(*) AS BIGINT) FROM customer GROUP BY 2
""")
def spec_two_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """One output over the pipeline view, one over an input view."""
    first, second = shared_dir(spark, "out-status"), shared_dir(spark, "out-segment")
    outputs = [
        {"query": "select 'status' as part, o_orderstatus as label, count(*) as n from #process group by 2",
         "action": "file", "format": "parquet", "output_location": first},
        {"query": "select 'segment' as part, c_mktsegment as label, count(*) as n from customer group by 2",
         "action": "file", "format": "parquet", "output_location": second, "partition_cols": "part"},
    ]
    inputs = [file_input(folder, "orders"), file_input(folder, "customer")]
    spec = load_pipeline(spec_document("statuses", inputs, "select * from orders", outputs), "statuses")
    run_pipeline(spark, spec)
    return spark.read.parquet(first).unionByName(spark.read.parquet(second))


@CATALOG.query("spec_vars", """
  SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n FROM orders
  WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-07-01' GROUP BY 1
""")
def spec_vars(spark: SparkSession, folder: str) -> DataFrame:
    """Run arguments replace #date and #date_to, longest name first."""
    variables = run_variables(["date=1996-01-01", "date_to=1998-07-01"])
    return through_spec(spark, "by_priority", [file_input(folder, "orders")], """
      SELECT o_orderpriority, count(*) AS n FROM orders
      WHERE o_orderdate >= TIMESTAMP_NTZ '#date' AND o_orderdate < TIMESTAMP_NTZ '#date_to' GROUP BY 1
    """, variables)


@CATALOG.query("spec_hook", """
  SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n, max(o_totalprice) AS top FROM orders
  WHERE o_totalprice > 250000 GROUP BY 1
""")
def spec_hook(spark: SparkSession, folder: str) -> DataFrame:
    """A registered hook on the input."""
    orders = file_input(folder, "orders", custom_preprocess_code_snippet="catalog.large_orders")
    return through_spec(spark, "large", [orders], """
      SELECT o_orderstatus, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY 1
    """)


@CATALOG.query("backfill_dates", """
  SELECT CAST(d AS DATE) AS load_date
  FROM (SELECT unnest(generate_series(max(CAST(ts AS DATE)) + 1, DATE '2024-03-01', INTERVAL 1 DAY)) AS d FROM events)
""")
def backfill_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Days after the last loaded one through the day before 2024-03-02."""
    return missing_days(table(spark, folder, "events"), "ts", F.lit("2024-03-02").cast("date"))


def _sql_query(name: str, tables: tuple[str, ...], text: str, twin: str | None = None) -> None:
    @CATALOG.query(name, twin or text)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return through_spec(spark, name, [file_input(folder, t) for t in tables], text)

    run.__doc__ = f"P7: {name} as the SQL of a spec."


_sql_query("sql_semi_join", ("customer", "orders"), """
  SELECT c_custkey, c_name FROM customer
  WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')
""")

_sql_query("sql_anti_join", ("customer", "orders"), """
  SELECT c_custkey, c_name FROM customer
  WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)
""")

_sql_query("sql_full_join", ("supplier", "customer"), """
  SELECT s_suppkey, c_custkey, coalesce(s_nationkey, c_nationkey) AS nationkey
  FROM (SELECT * FROM supplier WHERE s_acctbal > 5000) s
  FULL OUTER JOIN (SELECT * FROM customer WHERE c_acctbal > 9000) c ON s_suppkey = c_custkey
""")

_sql_query("sql_set_operations", ("customer", "supplier"), """
  SELECT 'intersect' AS op, k FROM (SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier) x
  UNION ALL
  SELECT 'except', k FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT s_suppkey FROM supplier) y
  UNION ALL
  SELECT 'union', k FROM (SELECT c_custkey AS k FROM customer UNION SELECT s_suppkey FROM supplier) z
""")

_sql_query("sql_rollup", ("lineitem",), """
  SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS n,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
  FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)
""")

_sql_query("sql_cube", ("orders",), """
  SELECT o_orderstatus, o_orderpriority, CAST(count(*) AS BIGINT) AS n
  FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)
""")

_sql_query("sql_grouping_sets", ("orders",), """
  SELECT o_orderstatus, o_orderpriority, CAST(count(*) AS BIGINT) AS n
  FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())
""")

# Ranks and frames run over aggregates whose group size is bounded (segments of a
# nation, months of a customer), so no window sorts an unbounded group.
_sql_query("sql_ranks", ("customer",), """
  SELECT c_nationkey, c_mktsegment, CAST(rank() OVER w AS BIGINT) AS rnk, CAST(dense_rank() OVER w AS BIGINT) AS dense_rnk,
         CAST(ntile(2) OVER (PARTITION BY c_nationkey ORDER BY n, c_mktsegment) AS BIGINT) AS half
  FROM (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY c_nationkey, c_mktsegment) g
  WINDOW w AS (PARTITION BY c_nationkey ORDER BY n)
""")

_sql_query("sql_lag_frames", ("orders",), """
  SELECT o_custkey, month_start, n, lag(n) OVER w AS previous_n,
         CAST(sum(n) OVER (PARTITION BY o_custkey ORDER BY month_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS recent,
         max(top) OVER (PARTITION BY o_custkey ORDER BY month_start
                        RANGE BETWEEN INTERVAL 90 DAYS PRECEDING AND CURRENT ROW) AS top_90
  FROM (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
               CAST(count(*) AS BIGINT) AS n, max(o_totalprice) AS top
        FROM orders GROUP BY 1, 2) g
  WINDOW w AS (PARTITION BY o_custkey ORDER BY month_start)
""")

_sql_query("sql_top_k", ("orders",), """
  SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25
""")

_sql_query("sql_top_k_per_group", ("orders",), """
  SELECT o_orderpriority, o_orderkey, o_totalprice FROM (
    SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) r
  WHERE rn <= 3
""")

_sql_query("sql_distinct_counts", ("lineitem",), """
  SELECT l_returnflag, CAST(count(DISTINCT l_partkey) AS BIGINT) AS parts,
         CAST(count(DISTINCT l_suppkey) AS BIGINT) AS suppliers FROM lineitem GROUP BY l_returnflag
""")

# Both counts ignore repeats, so repeats go first: otherwise a sketch is kept and shuffled for every status and part.
_sql_query("sql_approx_distinct", ("lineitem",), """
  SELECT l_linestatus, abs(approx_count_distinct(l_partkey) - count(l_partkey))
         < 0.15 * count(l_partkey) AS within_bound
  FROM (SELECT DISTINCT l_linestatus, l_partkey FROM lineitem) d GROUP BY l_linestatus
""", """
  SELECT l_linestatus, abs(approx_count_distinct(l_partkey) - count(DISTINCT l_partkey))
         < 0.15 * count(DISTINCT l_partkey) AS within_bound FROM lineitem GROUP BY l_linestatus
""")

_sql_query("sql_subqueries", ("orders", "customer"), """
  SELECT o_orderkey, o_totalprice FROM orders
  WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    AND o_totalprice > (SELECT avg(o_totalprice) FROM orders)
""")

_sql_query("sql_maps", ("events",), """
  SELECT event_type, CAST(sum(m['user']) AS BIGINT) AS users, CAST(max(m['event']) AS BIGINT) AS top_event
  FROM (SELECT event_type, map('user', user_id, 'event', event_id) AS m FROM events) x GROUP BY event_type
""", """
  SELECT event_type, CAST(sum(user_id) AS BIGINT) AS users, CAST(max(event_id) AS BIGINT) AS top_event
  FROM events GROUP BY event_type
""")

_sql_query("sql_conditional", ("orders",), """
  SELECT CASE WHEN o_totalprice < 100000 THEN 'low'
              WHEN o_totalprice BETWEEN 100000 AND 300000 THEN CASE WHEN o_orderstatus = 'F' THEN 'mid-f' ELSE 'mid' END
              ELSE 'high' END AS band,
         CAST(count(*) AS BIGINT) AS n
  FROM orders WHERE o_orderpriority LIKE '%-%' AND o_orderstatus IN ('F', 'O') GROUP BY 1
""")

_sql_query("text_functions", ("customer",), """
  SELECT c_custkey, concat_ws('~~', c_name, c_mktsegment) AS packed, substr(c_name, 1, 10) AS head,
         upper(c_mktsegment) AS upper_segment, regexp_replace(c_name, '[^a-zA-Z]', '-') AS dashed,
         md5(c_name) AS digest, concat(c_name, '!') AS shout
  FROM customer WHERE c_name LIKE 'Customer%'
""", """
  SELECT c_custkey, concat_ws('~~', c_name, c_mktsegment) AS packed, substr(c_name, 1, 10) AS head,
         upper(c_mktsegment) AS upper_segment, regexp_replace(c_name, '[^a-zA-Z]', '-', 'g') AS dashed,
         md5(c_name) AS digest, concat(c_name, '!') AS shout
  FROM customer WHERE c_name LIKE 'Customer%'
""")

_sql_query("date_functions", ("orders",), """
  SELECT o_orderkey, unix_timestamp(CAST(o_orderdate AS TIMESTAMP)) AS epoch,
         CAST(extract(YEAR FROM o_orderdate) AS BIGINT) AS yr, date_format(o_orderdate, 'yyyy-MM') AS ym,
         CAST(o_orderdate - INTERVAL 2 MINUTE AS STRING) AS earlier, make_date(year(o_orderdate), 8, 1) AS cutoff
  FROM orders
""", """
  SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) AS epoch,
         CAST(extract(YEAR FROM o_orderdate) AS BIGINT) AS yr, strftime(o_orderdate, '%Y-%m') AS ym,
         CAST(o_orderdate - INTERVAL 2 MINUTE AS VARCHAR) AS earlier,
         make_date(CAST(year(o_orderdate) AS BIGINT), 8, 1) AS cutoff
  FROM orders
""")

_sql_query("base64_roundtrip", ("customer",), """
  SELECT c_custkey, base64(encode(c_name, 'UTF-8')) AS encoded,
         decode(unbase64(base64(encode(c_name, 'UTF-8'))), 'UTF-8') AS decoded FROM customer
""", """
  SELECT c_custkey, base64(encode(c_name)) AS encoded, c_name AS decoded FROM customer
""")


@CATALOG.query("sql_as_of", """
  SELECT event_id, o_orderkey FROM (
    SELECT e.event_id, o.o_orderkey,
           row_number() OVER (PARTITION BY e.event_id ORDER BY o.at DESC, o.o_orderkey DESC) AS rn
    FROM events e JOIN (SELECT *, o_orderdate + to_minutes(o_orderkey % 1440) AS at FROM orders) o
      ON o.o_custkey = e.user_id AND o.at <= e.ts - INTERVAL 8 YEAR) x
  WHERE rn = 1
""")
def sql_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """Q23: latest order at or before each event, by time.

    Both sides form one timeline.  The last order before an event is looked up
    within the user's day; where the day has none yet, the last order of the
    user's earlier days is, from a table with one row per user and day.  No
    event-order pairs are formed, and no task holds more than a user's day.
    """
    inputs = [file_input(folder, "events"), file_input(folder, "orders")]
    return through_spec(spark, "as_of", inputs, """
      WITH timeline AS (
        SELECT user_id, ts - INTERVAL 8 YEAR AS at, 1 AS side, event_id, CAST(NULL AS BIGINT) AS o_orderkey FROM events
        UNION ALL
        SELECT o_custkey, o_orderdate + make_dt_interval(0, 0, CAST(o_orderkey % 1440 AS INT)), 0, CAST(NULL AS BIGINT),
               o_orderkey FROM orders),
      inside AS (
        SELECT user_id, CAST(at AS DATE) AS day, event_id, last_value(o_orderkey) IGNORE NULLS OVER (
          PARTITION BY user_id, CAST(at AS DATE) ORDER BY at, side, o_orderkey ROWS UNBOUNDED PRECEDING) AS found
        FROM timeline),
      days AS (
        SELECT user_id, CAST(at AS DATE) AS day,
               max_by(o_orderkey, CASE WHEN side = 0 THEN struct(at, o_orderkey) END) AS newest
        FROM timeline GROUP BY user_id, CAST(at AS DATE)),
      earlier AS (
        SELECT user_id, day, last_value(newest) IGNORE NULLS OVER (
          PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM days)
      SELECT i.event_id, coalesce(i.found, e.before) AS o_orderkey FROM inside i
      JOIN earlier e ON e.user_id = i.user_id AND e.day = i.day
      WHERE i.event_id IS NOT NULL AND coalesce(i.found, e.before) IS NOT NULL
    """)
