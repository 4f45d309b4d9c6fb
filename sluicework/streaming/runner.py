"""Micro-batch runner: streams -> SQL -> several outputs per batch."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sluicework.functions.dates import parse_text
from sluicework.plans.hooks import apply_hook
from sluicework.plans.runner import hooked, input_properties, pipeline_frame, register_inputs, write_outputs
from sluicework.plans.spec import (
    PipelineSpec, enabled_pipelines, flag, load_pipeline, substitute, substitute_all,
)
from sluicework.session import child_session, scratch_scope, shared_dir, ship_package
from sluicework.sources import STREAMS, read_stream
from sluicework.sources.changes import base_scan, earliest_before, rows_between, starting_point
from sluicework.streaming import incidents  # noqa: F401  registers its hook
from sluicework.streaming.latestart import LateStart
from sluicework.streaming.ranges import UNITS, batch_range, range_stream, utc_now

# Inputs read range by range: unit of the cap, its setting, where a new stream starts.
RANGE_INPUTS = {
    "okta": ("minutes", "max_minutes_per_trigger", "last_minute"),
    "ranged": ("minutes", "max_minutes_per_trigger", "last_minute"),
    "sfdc": ("days", "max_offset_days_per_trigger", "earliest"),
    "changes": ("days", "max_offset_days_per_trigger", "earliest"),
}


def _trigger(writer, properties: Mapping[str, str]):
    """``trigger=available_now`` drains and stops; otherwise ``window`` is the interval.

    A bare number counts seconds.
    """
    if properties.get("trigger") == "available_now":
        return writer.trigger(availableNow=True)
    window = properties.get("window", "0")
    return writer.trigger(processingTime=f"{window} seconds" if window.isdigit() else window)


def _checkpoint(session: SparkSession, properties: Mapping[str, str], name: str) -> str:
    # Without commits the checkpoint is a throw-away folder: a restart begins anew.
    if not flag(properties, "commit_offset", default=True):
        return shared_dir(session, f"checkpoint-{name}")
    if not properties.get("checkpoint_dir"):
        raise ValueError(f"stream {name} needs checkpoint_dir, or commit_offset=false")
    return properties["checkpoint_dir"]


def _start(
    session: SparkSession, stream: DataFrame, on_batch, properties: Mapping[str, str], name: str, checkpoint: str | None = None,
) -> StreamingQuery:
    checkpoint = checkpoint or _checkpoint(session, properties, name)

    def scoped(batch: DataFrame, batch_id: int) -> None:
        # What a batch stages is deleted when its outputs are written.
        with scratch_scope(batch.sparkSession):
            on_batch(batch, batch_id)

    writer = stream.writeStream.foreachBatch(scoped).option("checkpointLocation", checkpoint)
    return _trigger(writer, properties).start()


def batch_key(batch: DataFrame, batch_id: int | str) -> str:
    """Batch number plus the id of the query, which lives in its checkpoint.

    A replayed batch has the same key; a query started over on a new checkpoint
    counts from zero again but has other keys, so it overwrites nothing.
    """
    query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{batch_id}-{query_id}" if query_id else str(batch_id)


def _emit(batch: DataFrame, spec: PipelineSpec, batch_id: int | str, variables: Mapping[str, str]) -> None:
    """Write all outputs of one batch, computing the batch once."""
    key = batch_key(batch, batch_id)
    shared = len(spec.outputs) > 1
    if shared:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    batch.createOrReplaceTempView(spec.name)
    try:
        write_outputs(batch.sparkSession, spec, key, variables)
    finally:
        if shared:
            batch.unpersist()


def _watermarked(stream: DataFrame, spec: PipelineSpec) -> DataFrame:
    mark = spec.watermark
    return stream.withWatermark(mark["column"], mark["delay"]) if mark else stream


def _stream_view(session: SparkSession, raw: Mapping[str, str], enabled, variables, spec: PipelineSpec) -> dict[str, str]:
    properties = input_properties(raw, enabled, "real", variables)
    stream = _watermarked(hooked(read_stream(session, properties), properties), spec)
    stream.createOrReplaceTempView(properties["alias"])
    return properties


def start_stream(
    session: SparkSession, spec: PipelineSpec, enabled: Mapping[str, str], variables: Mapping[str, str],
) -> StreamingQuery:
    """All inputs are streams, or static when marked ``static=true``; SQL runs on the stream."""
    first = None
    for raw in spec.inputs:
        properties = input_properties(raw, enabled, "real", variables)
        if flag(properties, "static") or properties["format"].lower() not in STREAMS:
            register_inputs(session, spec, enabled, variables, "real", [raw])
        else:
            registered = _stream_view(session, raw, enabled, variables, spec)
            first = first or registered
    frame = pipeline_frame(session, spec, variables)
    return _start(session, frame, lambda batch, batch_id: _emit(batch, spec, batch_id, variables), first, spec.name)


def start_stream_static(
    session: SparkSession, spec: PipelineSpec, enabled: Mapping[str, str], variables: Mapping[str, str],
) -> StreamingQuery:
    """First input streams; the other inputs are read anew for every batch and SQL joins them."""
    properties = input_properties(spec.inputs[0], enabled, "real", variables)
    stream = hooked(read_stream(session, properties), properties)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        batch_session = batch.sparkSession
        batch.createOrReplaceTempView(properties["alias"])
        register_inputs(batch_session, spec, enabled, variables, "real", spec.inputs[1:])
        frame = apply_hook(
            batch_session.sql(substitute(spec.query, variables)), spec.hook_snippet, spec.hook_file)
        _emit(frame, spec, batch_id, variables)

    return _start(session, stream, on_batch, properties, spec.name)


def start_range_stream(
    session: SparkSession, spec: PipelineSpec, enabled: Mapping[str, str], variables: Mapping[str, str],
) -> StreamingQuery:
    """The first input is a table read by change time, one capped range per batch.

    On an empty table a stream from the earliest row waits for one, whatever its time.
    """
    raw = input_properties(spec.inputs[0], enabled, "real", variables)
    properties = substitute_all(raw, raw)
    unit, cap_key, policy = RANGE_INPUTS[properties["format"].lower()]
    until = properties.get("until")
    now = parse_text(until) if until else utc_now()
    cap = int(properties[cap_key])
    start = starting_point(lambda: base_scan(session, properties), properties, now, policy)
    checkpoint = _checkpoint(session, properties, spec.name)
    late = LateStart(session, checkpoint, start is None)
    ranges = range_stream(session, start or now, cap, unit, parse_text(until) if until else None)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        found = batch_range(batch)
        if found is None:
            return
        batch_session = batch.sparkSession
        pieces = late.bounds(batch_id, *found, cap, UNITS[unit], lambda end: earliest_before(batch_session, properties, end))
        for at, bounds in enumerate(pieces):
            hooked(rows_between(batch_session, properties, *bounds), properties).createOrReplaceTempView(properties["alias"])
            register_inputs(batch_session, spec, enabled, variables, "real", spec.inputs[1:])
            frame = apply_hook(
                batch_session.sql(substitute(spec.query, variables)), spec.hook_snippet, spec.hook_file)
            _emit(frame, spec, batch_id if len(pieces) == 1 else f"{batch_id}.{at}", variables)

    return _start(session, ranges, on_batch, properties, spec.name, checkpoint)


def start_pipeline(
    spark: SparkSession, spec: PipelineSpec, enabled: Mapping[str, str] | None = None,
    variables: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Start one streaming pipeline in its own child session."""
    enabled, variables = enabled or {}, variables or {}
    ship_package(spark)
    session = child_session(spark, spec.sql_conf)
    if spec.inputs[0]["format"].lower() in RANGE_INPUTS:
        return start_range_stream(session, spec, enabled, variables)
    if spec.kind == "real_static":
        return start_stream_static(session, spec, enabled, variables)
    return start_stream(session, spec, enabled, variables)


def run_streams(
    spark: SparkSession, config: str | Mapping, enable: str | Mapping, variables: Mapping[str, str] | None = None,
) -> list[StreamingQuery]:
    """Start every enabled streaming pipeline; the caller waits on any of them."""
    return [
        start_pipeline(spark, load_pipeline(config, name), properties, variables)
        for name, properties in enabled_pipelines(enable).items()
    ]


def await_any(spark: SparkSession) -> None:
    spark.streams.awaitAnyTermination()


def drain(query: StreamingQuery) -> None:
    """Process what is there now, then stop."""
    query.processAllAvailable()
    query.stop()
