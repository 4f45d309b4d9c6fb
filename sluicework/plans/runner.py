"""Batch runner: inputs -> views -> SQL -> outputs."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from sluicework.operators import activity  # noqa: F401  registers its hook
from sluicework.plans import runlog
from sluicework.plans.hooks import apply_hook
from sluicework.plans.spec import (
    PipelineSpec, enabled_pipelines, load_pipeline, merge_properties, substitute, substitute_all,
)
from sluicework.session import child_session, scratch_scope, ship_package, through_storage
from sluicework.sinks import write_output
from sluicework.sources import read_input
from sluicework.sources.kafka import commit_read, decoded, staged_batch

MAX_PARALLEL_OUTPUTS = 8


@dataclass
class BatchRun:
    """What one pipeline run left behind."""

    name: str
    run_id: str
    session: SparkSession
    frame: DataFrame


def input_properties(
    raw: Mapping[str, str], enabled: Mapping[str, str], mode: str, variables: Mapping[str, str],
) -> dict[str, str]:
    """Input keys, then enable properties, then the run mode, then run arguments."""
    return merge_properties(raw, enabled, {"process": mode}, variables)


def hooked(df: DataFrame, properties: Mapping[str, str]) -> DataFrame:
    return apply_hook(
        df, properties.get("custom_preprocess_code_snippet", ""), properties.get("custom_preprocess_file", ""))


def register_inputs(
    session: SparkSession, spec: PipelineSpec, enabled: Mapping[str, str], variables: Mapping[str, str],
    mode: str = "batch", inputs: Sequence[Mapping[str, str]] | None = None,
) -> list[tuple[DataFrame, dict[str, str]]]:
    """Register every input as a view; returns staged Kafka reads to commit later."""
    commits = []
    for raw in inputs if inputs is not None else spec.inputs:
        properties = input_properties(raw, enabled, mode, variables)
        if properties["format"].lower() == "kafka" and "commit_table" in properties:
            resolved = substitute_all(properties, properties)
            rows = staged_batch(session, resolved)
            commits.append((rows, resolved))
            df = decoded(rows, resolved)
        else:
            df = read_input(session, properties)
        hooked(df, properties).createOrReplaceTempView(properties["alias"])
    return commits


def pipeline_frame(session: SparkSession, spec: PipelineSpec, variables: Mapping[str, str]) -> DataFrame:
    """Run the pipeline SQL and hook, and register the result under the pipeline name."""
    df = session.sql(substitute(spec.query, variables))
    df = apply_hook(df, spec.hook_snippet, spec.hook_file)
    df.createOrReplaceTempView(spec.name)
    return df


def write_outputs(
    session: SparkSession, spec: PipelineSpec, batch_id: object, variables: Mapping[str, str],
) -> None:
    """Each output runs its own SQL and hook over the registered views into its own sink."""

    def one(index: int, raw: Mapping[str, str]) -> None:
        names = {**variables, "process": spec.name}
        properties = {**substitute_all(raw, names), "output_index": str(index)}
        df = apply_hook(
            session.sql(properties["query"]),
            properties.get("custom_postprocess_code_snippet", ""), properties.get("custom_postprocess_file", ""))
        write_output(df, batch_id, properties)

    if len(spec.outputs) == 1:
        one(0, spec.outputs[0])
        return
    workers = min(len(spec.outputs), MAX_PARALLEL_OUTPUTS)
    with ThreadPoolExecutor(workers) as pool:
        tasks = [
            pool.submit(copy_context().run, inheritable_thread_target(session)(one), index, raw)
            for index, raw in enumerate(spec.outputs)
        ]
        for task in tasks:
            task.result()


def shared_frame(df: DataFrame, spec: PipelineSpec, share: str) -> DataFrame:
    """Compute a frame several outputs read only once.

    ``persist`` keeps it on the executors; ``stage`` writes it to the shared
    folder, which also outlives executors and lets each output prune columns;
    ``none`` recomputes, right when outputs read small parts of a large scan.
    """
    readers = sum("#process" in output["query"] for output in spec.outputs)
    if readers < 2 or share == "none":
        return df
    if share == "stage":
        # A copy that is soon read back and deleted does not repay dictionaries.
        staged = through_storage(df, spec.name, {"parquet.enable.dictionary": "false"})
        staged.createOrReplaceTempView(spec.name)
        return staged
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def run_pipeline(
    spark: SparkSession,
    spec: PipelineSpec,
    enabled: Mapping[str, str] | None = None,
    variables: Mapping[str, str] | None = None,
    run_id: str | None = None,
    write: bool = True,
) -> BatchRun:
    """Run one batch pipeline in its own child session."""
    enabled, variables = enabled or {}, variables or {}
    ship_package(spark)
    session = child_session(spark, spec.sql_conf)
    run = run_id or uuid.uuid4().hex
    if not write:
        register_inputs(session, spec, enabled, variables)
        return BatchRun(spec.name, run, session, pipeline_frame(session, spec, variables))
    # Copies staged for this run are of no use after it.
    with scratch_scope(session):
        commits = register_inputs(session, spec, enabled, variables)
        frame = pipeline_frame(session, spec, variables)
        shared = shared_frame(frame, spec, enabled.get("share_output", "persist"))
        try:
            write_outputs(session, spec, run, variables)
        finally:
            shared.unpersist()
        for rows, properties in commits:
            commit_read(rows, properties, run)
    return BatchRun(spec.name, run, session, frame)


class PipelinesFailed(RuntimeError):
    """At least one enabled pipeline failed; carries the summary text."""


def run_batch(
    spark: SparkSession,
    config: str | Mapping,
    enable: str | Mapping,
    variables: Mapping[str, str] | None = None,
    log_path: str | None = None,
) -> list[BatchRun]:
    """Run every enabled pipeline; all are tried, failures are raised together."""
    runs, failures = [], []
    for name, properties in enabled_pipelines(enable).items():
        spec = load_pipeline(config, name)
        run = uuid.uuid4().hex
        runlog.record(spark, log_path, name, run, "Started")
        try:
            runs.append(run_pipeline(spark, spec, properties, variables, run))
            runlog.record(spark, log_path, name, run, "Finished")
        except Exception as error:  # noqa: BLE001 - reported below
            runlog.record(spark, log_path, name, run, "Failed", error)
            failures.append((name, error))
    if failures:
        raise PipelinesFailed(runlog.summary(failures))
    return runs
