"""Time-range extraction, upserts, reloads, routing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicework.catalog.core import Catalog, table
from sluicework.operators import columns, snapshots, timerange
from sluicework.session import shared_dir
from sluicework.sinks.files import stage_by_bucket, write_routed_file
from sluicework.sources.changes import read_changes

CATALOG = Catalog()

BUFFER = 500

PLAN_SQL = """
  SELECT second_ts, row_count, running_count, CAST(running_count // 500 AS BIGINT) AS bucket FROM (
    SELECT second_ts, row_count, CAST(sum(row_count) OVER (ORDER BY second_ts) AS BIGINT) AS running_count FROM (
      SELECT date_trunc('second', ts) AS second_ts, CAST(count(*) AS BIGINT) AS row_count FROM events GROUP BY 1))
"""


@CATALOG.query("bucket_plan", PLAN_SQL)
def bucket_plan(spark: SparkSession, folder: str) -> DataFrame:
    """Running row count per second and its bucket."""
    return timerange.bucket_plan(table(spark, folder, "events"), "ts", BUFFER)


@CATALOG.query("bucket_ranges", f"""
  SELECT bucket, start_ts, lead(start_ts) OVER (ORDER BY bucket) AS end_ts
  FROM (SELECT bucket, min(second_ts) AS start_ts FROM ({PLAN_SQL}) GROUP BY bucket)
""")
def bucket_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Ranges that tile the series, the last one open."""
    return timerange.bucket_ranges(timerange.bucket_plan(table(spark, folder, "events"), "ts", BUFFER))


@CATALOG.query("bucketed_extract", f"""
  SELECT CAST(bucket AS BIGINT) AS bucket, CAST(count(*) AS BIGINT) AS n, min(ts) AS first_ts, max(ts) AS last_ts
  FROM events JOIN ({PLAN_SQL}) p ON date_trunc('second', ts) = second_ts GROUP BY bucket
""")
def bucketed_extract(spark: SparkSession, folder: str) -> DataFrame:
    """Rows staged by bucket and read back."""
    staged = timerange.bucketed_extract(
        table(spark, folder, "events"), "ts", BUFFER, shared_dir(spark, "extract"))
    return staged.groupBy(F.col("bucket").cast("bigint").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@CATALOG.query("range_extract", """
  SELECT event_type, CAST(count(*) AS BIGINT) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM events
  WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' AND event_type <> 'view' GROUP BY event_type
""")
def range_extract(spark: SparkSession, folder: str) -> DataFrame:
    """Half-open range with a condition, pushed to the scan."""
    rows = read_changes(spark, {
        "path": f"{folder}/events.parquet", "ts_col": "ts", "start_time": "2024-01-10T00:00:00Z",
        "end_time": "2024-01-20 00:00:00", "condition": "event_type <> 'view'", "buffer_size": str(10**12)})
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@CATALOG.query("size_switch", """
  SELECT 'direct' AS path, CAST(count(*) AS BIGINT) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events
  UNION ALL SELECT 'bucketed', CAST(count(*) AS BIGINT), CAST(sum(event_id) AS BIGINT) FROM events
""")
def size_switch(spark: SparkSession, folder: str) -> DataFrame:
    """Same rows whether the buffer holds them or not."""
    events = table(spark, folder, "events")
    direct = timerange.extract(events, "ts", 10**12, shared_dir(spark, "direct"))
    bucketed = timerange.extract(events, "ts", 2 * BUFFER, shared_dir(spark, "bucketed"))
    parts = [
        rows.agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum")).select(F.lit(path).alias("path"), "*")
        for path, rows in (("direct", direct), ("bucketed", bucketed))
    ]
    return parts[0].unionByName(parts[1])


@CATALOG.query("upsert_latest", """
  SELECT user_id, event_id, event_type, ts FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1
""")
def upsert_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Three batches, one repeated, into a keyed file table."""
    events = table(spark, folder, "events").select("user_id", "event_id", "event_type", "ts")
    target = shared_dir(spark, "upsert")
    for part in (0, 1, 0, 2):
        snapshots.upsert(events.filter(F.col("event_id") % 3 == part), target, ["user_id"], "ts", buckets=16)
    return snapshots.read_keyed(spark, target).select("user_id", "event_id", "event_type", "ts")


@CATALOG.query("reload_last_n_days", """
  SELECT event_id, event_type, CAST(ts AS DATE) AS load_day FROM events
  WHERE ts < TIMESTAMP '2024-01-20' OR event_type = 'click'
""")
def reload_last_n_days(spark: SparkSession, folder: str) -> DataFrame:
    """The last five days replaced by what the new frame holds."""
    events = table(spark, folder, "events").select("event_id", "event_type", "ts")
    target = shared_dir(spark, "reload")
    now = datetime(2024, 1, 25, 15, 30)
    snapshots.reload_days(events, target, "ts", 5, now)
    fresh = events.filter("ts >= TIMESTAMP_NTZ '2024-01-20' AND event_type = 'click'")
    snapshots.reload_days(fresh, target, "ts", 5, now)
    return snapshots.read_days(spark, target).select("event_id", "event_type", "load_day")


@CATALOG.query("cast_to_target", """
  SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(14,2)) AS "O_TOTALPRICE", CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
""")
def cast_to_target(spark: SparkSession, folder: str) -> DataFrame:
    """Target columns the frame has, in target order and type."""
    orders = table(spark, folder, "orders")
    text = orders.select(*[F.col(c).cast("string") for c in orders.columns])
    target = T.StructType.fromDDL(
        "o_orderkey BIGINT, not_there STRING, O_TOTALPRICE DECIMAL(14,2), o_orderdate DATE")
    return columns.cast_to_target(text, target)


@CATALOG.query("time_routed_counts", """
  SELECT 'orders-' || strftime(o_orderdate, '%Y-%m') AS target_index, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1
""")
def time_routed_counts(spark: SparkSession, folder: str) -> DataFrame:
    """One target per month."""
    target = shared_dir(spark, "routed")
    write_routed_file(table(spark, folder, "orders"), 0, {
        "index": "orders", "ts_col": "o_orderdate", "ts_format": "YYYY-MM", "output_location": target})
    return spark.read.parquet(target).groupBy("target_index").agg(F.count(F.lit(1)).alias("n"))


@CATALOG.query("staged_buckets", """
  SELECT CAST(o_orderkey % 7 AS INTEGER) AS bucket, CAST(count(*) AS BIGINT) AS n FROM orders
  WHERE o_orderkey % 7 <> 3 OR o_orderstatus = 'F' GROUP BY 1
""")
def staged_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """Rewriting one bucket leaves the others alone."""
    orders = table(spark, folder, "orders").withColumn("bucket", (F.col("o_orderkey") % 7).cast("int"))
    location = shared_dir(spark, "staged")
    stage_by_bucket(orders, location, "orders")
    stage_by_bucket(orders.filter("bucket = 3 AND o_orderstatus = 'F'"), location, "orders")
    return spark.read.parquet(f"{location}/orders").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


@CATALOG.query("size_switch_nulls", """
  SELECT path, CAST(count(*) AS BIGINT) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum, CAST(count(seen) AS BIGINT) AS timed
  FROM (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN ts END AS seen FROM events WHERE event_type <> 'view') e,
       (SELECT unnest(['direct', 'bucketed']) AS path) p GROUP BY path
""")
def size_switch_nulls(spark: SparkSession, folder: str) -> DataFrame:
    """Rows without a time and a condition, alike on both sides of the buffer size."""
    events = table(spark, folder, "events").withColumn("seen", F.when(F.col("event_id") % 7 != 0, F.col("ts")))
    location = shared_dir(spark, "timed")
    events.write.parquet(location)
    asked = {"path": location, "ts_col": "seen", "condition": "event_type <> 'view'", "columns": "event_id,event_type,seen"}
    parts = [
        read_changes(spark, {**asked, "buffer_size": str(size)}).agg(
            F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"), F.count("seen").alias("timed"))
        .select(F.lit(path).alias("path"), "*")
        for path, size in (("direct", 10**12), ("bucketed", BUFFER))
    ]
    return parts[0].unionByName(parts[1])


@CATALOG.query("upsert_rebucketed", """
  SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 <> 0
  UNION ALL SELECT o_orderkey, 'new' FROM orders WHERE o_orderkey % 3 = 0
""")
def upsert_rebucketed(spark: SparkSession, folder: str) -> DataFrame:
    """A table keeps the number of buckets it was written with."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    target = shared_dir(spark, "rebucketed")
    snapshots.upsert(orders, target, ["o_orderkey"], buckets=16)
    later = orders.filter("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("new"))
    snapshots.upsert(later, target, ["o_orderkey"], buckets=64)
    return snapshots.read_keyed(spark, target).select("o_orderkey", "o_orderstatus")


@CATALOG.query("reload_twice", """
  SELECT event_id, event_type, CAST(ts AS DATE) AS load_day FROM events
  UNION ALL SELECT event_id, event_type, CAST(ts AS DATE) FROM events WHERE event_id % 5 = 0
""")
def reload_twice(spark: SparkSession, folder: str) -> DataFrame:
    """A reload that is repeated changes nothing, and repeated rows keep their number."""
    events = table(spark, folder, "events").select("event_id", "event_type", "ts")
    target = shared_dir(spark, "reload-twice")
    now = datetime(2024, 1, 25, 15, 30)
    snapshots.reload_days(events, target, "ts", 5, now)
    for _ in range(2):
        snapshots.reload_days(events.unionByName(events.where("event_id % 5 = 0")), target, "ts", 5, now)
    return snapshots.read_days(spark, target).select("event_id", "event_type", "load_day")


@CATALOG.query("upsert_deltas", """
  SELECT 'first' AS version, o_orderstatus, CAST(count(*) AS BIGINT) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 2
  UNION ALL SELECT 'last', CASE WHEN o_orderkey % 7 = 0 THEN 'second' WHEN o_orderkey % 3 = 0 THEN 'new' ELSE o_orderstatus END,
    CAST(count(*) AS BIGINT), CAST(sum(o_orderkey) AS BIGINT) FROM orders GROUP BY 2
""")
def upsert_deltas(spark: SparkSession, folder: str) -> DataFrame:
    """Batches as deltas, one of them twice, read as first and as last version."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    target = shared_dir(spark, "deltas")
    first = snapshots.upsert(orders, target, ["o_orderkey"], buckets=16, writer="w", number=0)
    for number, (part, status) in enumerate((("o_orderkey % 3 = 0", "new"), ("o_orderkey % 7 = 0", "second"),
                                             ("o_orderkey % 7 = 0", "never")), 1):
        # The last batch has the number of the one before, so it is known already.
        snapshots.upsert(orders.where(part).withColumn("o_orderstatus", F.lit(status)), target, ["o_orderkey"],
                         writer="w", number=min(number, 2))
    parts = [
        snapshots.read_keyed(spark, target, version).groupBy("o_orderstatus").agg(
            F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys")).select(F.lit(name).alias("version"), "*")
        for name, version in (("first", first), ("last", None))
    ]
    return parts[0].unionByName(parts[1])


@CATALOG.query("upsert_compacted", """
  SELECT user_id, event_id, event_type, ts FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1
""")
def upsert_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """Deltas merged into the base between batches; an older row of a later batch does not win."""
    events = table(spark, folder, "events").select("user_id", "event_id", "event_type", "ts")
    target = shared_dir(spark, "compacted")
    for part in (2, 0, 1):
        snapshots.upsert(events.filter(F.col("event_id") % 3 == part), target, ["user_id"], "ts", buckets=16)
        if part != 1:
            snapshots.compact(spark, target)
    snapshots.vacuum(spark, target, older_than_seconds=0)
    return snapshots.read_keyed(spark, target).select("user_id", "event_id", "event_type", "ts")


@CATALOG.query("range_partitioned_extract", """
  WITH e AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-15' ELSE ts END AS seen FROM events)
  SELECT 'n' AS fact, CAST(count(*) AS BIGINT) AS value FROM e UNION ALL SELECT 'id_sum', CAST(sum(event_id) AS BIGINT) FROM e
  UNION ALL SELECT 'untimed', CAST(count(*) AS BIGINT) FROM e WHERE seen IS NULL
  UNION ALL SELECT 'overfull', 0 UNION ALL SELECT 'disordered', 0 UNION ALL SELECT 'several', 1
""")
def range_partitioned_extract(spark: SparkSession, folder: str) -> DataFrame:
    """Balanced ranges from a quantile sketch; a third of the rows share one instant, some have none."""
    events = table(spark, folder, "events").withColumn(
        "seen", F.when(F.col("event_id") % 7 == 0, None).when(F.col("event_id") % 3 == 0, F.lit(datetime(2024, 1, 15)).cast("timestamp_ntz"))
        .otherwise(F.col("ts")))
    staged = timerange.range_partitioned_extract(events, "seen", BUFFER, shared_dir(spark, "ranged"))
    buckets = staged.where("bucket IS NOT NULL").groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.min("seen").alias("first"), F.max("seen").alias("last"))
    before = F.max("last").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))

    def told(rows: DataFrame, **facts) -> DataFrame:
        named = [F.struct(F.lit(name).alias("fact"), fact.cast("bigint").alias("value")) for name, fact in facts.items()]
        return rows.agg(F.array(*named).alias("facts")).select(F.inline("facts"))

    return told(staged, n=F.count(F.lit(1)), id_sum=F.sum("event_id"), untimed=F.count_if(F.col("bucket").isNull())).unionByName(
        told(buckets.select("rows", (F.col("first") < before).alias("early")), overfull=F.count_if(F.col("rows") > BUFFER),
             disordered=F.count_if("early"), several=F.count(F.lit(1)) > 1))
