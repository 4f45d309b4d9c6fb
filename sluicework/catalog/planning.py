"""Runs of whole configurations: run log, variables, save modes, backfill, and file inputs by format."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.catalog.core import Catalog, file_input, spec_document, table
from sluicework.catalog.pipelines import through_spec
from sluicework.plans import runlog
from sluicework.plans.backfill import backfill_batch
from sluicework.plans.runner import PipelinesFailed, run_batch
from sluicework.session import shared_dir, write_text

CATALOG = Catalog()


def enable_document(**pipelines: dict | None) -> dict:
    """Enable file: pipelines with their properties, None for a disabled one."""
    return {"process": {"actions": {
        name: {"isEnabled": "false" if properties is None else "true", "properties": properties or {}}
        for name, properties in pipelines.items()}}}


def parquet_output(location: str, query: str = "select * from #process", **extra: str) -> dict:
    return {"query": query, "action": "file", "format": "parquet", "output_location": location, **extra}


@CATALOG.query("run_batch_log", """
  SELECT 'log' AS part, unnest(['broken', 'broken', 'segments', 'segments']) AS label,
         unnest(['Failed', 'Started', 'Finished', 'Started']) AS status, CAST(1 AS BIGINT) AS n
  UNION ALL SELECT 'segments', c_mktsegment, 'high', CAST(count(*) AS BIGINT) FROM customer WHERE c_acctbal > 1000 GROUP BY 2
""")
def run_batch_log(spark: SparkSession, folder: str) -> DataFrame:
    """A good, a broken and a disabled pipeline; all are tried, properties and arguments merge, runs are logged."""
    target, log = shared_dir(spark, "batch-out"), shared_dir(spark, "batch-log")
    process = {}
    for name, query in (("segments", "select c_mktsegment as label, '#level' as status, count(*) as n from customer where c_acctbal > #low group by 1"),
                        ("broken", "select missing from customer"), ("off", "select missing from customer")):
        process |= spec_document(name, [file_input(folder, "customer")], query, [parquet_output(target)])["process"]
    try:
        run_batch(spark, {"appName": "catalog", "process": process},
                  enable_document(broken={}, segments={"share_output": "none"}, off=None), {"low": "1000", "level": "high"}, log)
    except PipelinesFailed as failed:
        if not str(failed).startswith("broken:"):
            raise
    logged = runlog.read(spark, log).groupBy(F.col("dataset_id").alias("label"), "status").agg(F.count(F.lit(1)).alias("n"))
    written = spark.read.parquet(target).select("label", "status", "n")
    return logged.select(F.lit("log").alias("part"), "*").unionByName(written.select(F.lit("segments").alias("part"), "*"))


@CATALOG.query("backfill_spec", """
  SELECT CAST(ts AS DATE) AS day, event_type, CAST(count(*) AS BIGINT) AS n FROM events
  WHERE ts < TIMESTAMP '2024-01-24' GROUP BY 1, 2
""")
def backfill_spec(spark: SparkSession, folder: str) -> DataFrame:
    """A specification run once for each day after the last one its target holds."""
    target = shared_dir(spark, "backfill")
    counts = "select cast(ts as date) as day, event_type, count(*) as n from events where {} group by 1, 2"
    events = file_input(folder, "events")
    first = spec_document("days", [events], counts.format("ts < timestamp_ntz'2024-01-21'"), [parquet_output(target)])
    run_batch(spark, first, enable_document(days={}))
    daily = spec_document("days", [events], counts.format("cast(ts as date) = date'#date'"), [parquet_output(target)])
    backfill_batch(spark, daily, enable_document(days={}), spark.read.parquet(target), "day", until="2024-01-24")
    return spark.read.parquet(target)


@CATALOG.query("save_modes", """
  SELECT mode, CAST(count(*) * times AS BIGINT) AS n, CAST(sum(s_suppkey) * times AS BIGINT) AS keys FROM supplier,
    (SELECT unnest(['append', 'overwrite', 'ignore', 'default']) AS mode, unnest([2, 1, 1, 2]) AS times) GROUP BY mode, times
""")
def save_modes(spark: SparkSession, folder: str) -> DataFrame:
    """Each save mode written twice, with retries of a write; the console gets no rows."""
    parts = []
    for mode in ("append", "overwrite", "ignore", "default"):
        target = shared_dir(spark, f"mode-{mode}")
        outputs = [parquet_output(target, sink_attempts="2", sink_retry_wait="0", **({} if mode == "default" else {"mode": mode})),
                   {"query": "select * from #process limit 0", "action": "console"}]
        document = spec_document("suppliers", [file_input(folder, "supplier")], "select * from supplier", outputs)
        for _ in range(2):
            run_batch(spark, document, enable_document(suppliers={"share_output": "none"}))
        parts.append(spark.read.parquet(target).agg(F.count(F.lit(1)).alias("n"), F.sum("s_suppkey").alias("keys")).select(
            F.lit(mode).alias("mode"), "*"))
    first, *others = parts
    for other in others:
        first = first.unionByName(other)
    return first


@CATALOG.query("csv_source", """
  SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys, CAST(sum(c_nationkey) AS BIGINT) AS nations,
    max(c_name) AS last_name FROM customer GROUP BY 1
""")
def csv_source(spark: SparkSession, folder: str) -> DataFrame:
    """A CSV input with its delimiter, header and inferred types."""
    landing = shared_dir(spark, "csv")
    table(spark, folder, "customer").write.option("header", True).option("delimiter", ";").csv(landing)
    source = {"format": "file", "file_format": "csv", "path": landing, "header": "true", "delimiter": ";", "inferSchema": "true",
              "alias": "customer"}
    return through_spec(spark, "from_csv", [source], """
      select c_mktsegment, count(*) as n, sum(c_custkey) as keys, sum(c_nationkey) as nations, max(c_name) as last_name
      from customer group by 1""")


@CATALOG.query("json_lines_source", """
  SELECT p_partkey, p_name, p_brand, p_type FROM part WHERE p_partkey % 5 <> 0
  UNION ALL SELECT p_partkey, NULL, p_brand, p_type FROM part WHERE p_partkey % 5 = 0
""")
def json_lines_source(spark: SparkSession, folder: str) -> DataFrame:
    """Export lines typed by a declared schema; absent fields are null."""
    landing = shared_dir(spark, "json-lines")
    part = table(spark, folder, "part")
    part.select(F.to_json(F.struct(
        "p_partkey", F.when(F.col("p_partkey") % 5 != 0, F.col("p_name")).alias("p_name"), "p_brand", "p_type")).alias("value")
    ).write.text(landing)
    source = {"format": "peopleai", "path": landing, "alias": "lines",
              "schema_ddl": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING"}
    return through_spec(spark, "from_lines", [source], "select * from lines")


@CATALOG.query("avsc_schema", """
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, CAST(NULL AS VARCHAR) AS note FROM orders
""")
def avsc_schema(spark: SparkSession, folder: str) -> DataFrame:
    """An Avro schema file as the schema of an input."""
    landing, schemas = shared_dir(spark, "avsc-json"), shared_dir(spark, "avsc")
    table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").write.json(landing)
    text = {"type": "enum", "name": "status", "symbols": ["O", "F", "P"]}
    write_text(spark, f"{schemas}/order.avsc", json.dumps({"type": "record", "name": "order", "fields": [
        {"name": "o_orderkey", "type": "long"}, {"name": "o_custkey", "type": ["null", "int", "long"]},
        {"name": "o_orderstatus", "type": text}, {"name": "o_orderpriority", "type": ["null", "string"]},
        {"name": "note", "type": ["null", "string"], "default": None}]}))
    source = {"format": "file", "file_format": "json", "path": landing, "schema": "order", "schema_location": schemas, "alias": "orders"}
    return through_spec(spark, "from_avsc", [source], "select * from orders")
