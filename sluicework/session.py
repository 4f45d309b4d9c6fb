"""Session defaults, shared folders and file-system helpers."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Settings a pipeline relies on.  All are runtime SQL settings, so they can be
# copied into the child session each pipeline runs in.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Settings a child session inherits from the session the caller handed over.
INHERITED = (
    "spark.sql.shuffle.partitions",
    "spark.sql.ansi.enabled",
    "spark.sql.files.maxPartitionBytes",
    "spark.sql.autoBroadcastJoinThreshold",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    "spark.sql.streaming.stateStore.providerClass",
    "sluicework.shared.dir",
)

CHECKPOINT_DIR = "spark.checkpoint.dir"
SHARED_DIR = "sluicework.shared.dir"


def build_session(app_name: str = "sluicework", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the defaults above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def child_session(spark: SparkSession, overrides: dict[str, str] | None = None) -> SparkSession:
    """A session with its own views and SQL settings over the same cluster.

    Pipelines run side by side, so each gets its own view namespace.
    """
    child = spark.newSession()
    for key in INHERITED:
        value = spark.conf.get(key, None)
        if value is not None:
            child.conf.set(key, value)
    for key, value in {**SQL_DEFAULTS, **(overrides or {})}.items():
        child.conf.set(key, value)
    return child


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Every executor must be able to read what is written here, so the cluster's
    own setting is used, or the option ``sluicework.shared.dir`` of the session.
    Without either, a session on one machine uses its warehouse folder; on a
    cluster that is an error.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.conf.get(SHARED_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError(f"no shared folder: set {CHECKPOINT_DIR}, or {SHARED_DIR} on the session")
        root = f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared"
    return root.rstrip("/")


_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder path below the shared root."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    opened = _scope.get()
    if opened is not None:
        opened.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the shared folders handed out inside the block when it ends."""
    opened: list[str] = []
    token = _scope.set(opened)
    try:
        yield opened
    finally:
        _scope.reset(token)
        for path in opened:
            delete_path(spark, path)


def _fs_path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs_path(spark, path)
    return bool(fs.exists(hadoop_path))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder on whatever file system the path names."""
    fs, hadoop_path = _fs_path(spark, path)
    return bool(fs.delete(hadoop_path, True))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small text in the place of a file by renaming a finished copy onto it."""
    jvm = spark._jvm
    fs, place = _fs_path(spark, path)
    pending = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(pending)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(place).toUri(), spark._jsc.hadoopConfiguration())
    options = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(pending), fs.makeQualified(place), options)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if it is not there."""
    fs, place = _fs_path(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def is_committed(spark: SparkSession, path: str) -> bool:
    """True when a Spark write to ``path`` finished."""
    return path_exists(spark, f"{path}/_SUCCESS")


def through_storage(df: DataFrame, label: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write a frame once to the shared folder and read it back.

    Used where several jobs read one expensive result: the copy survives the
    loss of executors and each reader gets column pruning and filter push-down.
    """
    path = shared_dir(df.sparkSession, label)
    df.write.mode("overwrite").options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def register_source(spark: SparkSession, source: type) -> str:
    """Register a Python data source in a session and return the name to read it by.

    Spark looks for a taken name in the active session, which may be another one
    than the session at hand; the source then gets a name of its own.
    """
    try:
        spark.dataSource.register(source)
        return source.name()
    except AnalysisException as error:
        if error.getCondition() != "DATA_SOURCE_ALREADY_EXISTS":
            raise
    unique = f"{source.name()}_{uuid.uuid4().hex[:8]}"
    spark.dataSource.register(type(source.__name__, (source,), {"name": classmethod(lambda cls: unique)}))
    return unique


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application.

    The sources and hooks that run Python in tasks import their classes by
    name, so the workers need the package whatever folder they start in.
    """
    import io
    import pathlib
    import zipfile

    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = pathlib.Path(__file__).parent
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    fs, target = _fs_path(spark, f"{shared_dir(spark, 'package')}/sluicework.zip")
    stream = fs.create(target)
    stream.write(bytearray(buffer.getvalue()))
    stream.close()
    spark.sparkContext.addPyFile(fs.makeQualified(target).toString())
    _shipped.add(application)
