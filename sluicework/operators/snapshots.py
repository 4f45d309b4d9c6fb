"""File tables with snapshots: keyed tables merged on read, day tables reloaded by day.

A table is a folder of Parquet files that are never changed, and a list of
manifests, one per version.  A manifest names the files of its version, so a
reader that has one sees a whole table whatever is written meanwhile.  A writer
puts its files into a folder of its own, then writes the next manifest under
another name and renames it: that rename is the commit.  It fails if the version
exists already; the writer then takes up the newer manifest and tries again with
the files it has.  Nothing is deleted but by :func:`vacuum`.

A keyed table has base files by hash bucket of the key and a log of deltas.  An
upsert writes the rows of its batch and nothing else; a read lets the deltas' rows
win; :func:`compact` merges buckets that deltas touch into new base files.  A day
table names for each day its files, its number of rows and an order-free digest of
them, so a reload replaces days in the manifest alone and compares older days by
digest before it reads any of their rows.

The file system must rename atomically and refuse to rename onto a file, as HDFS
and local disks do.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicework.functions.dates import last_days_start
from sluicework.operators.skew import balanced
from sluicework.operators.upsert import BUCKET, key_bucket, latest_per_key, tie_break
from sluicework.session import delete_path, path_exists, read_text

COMMIT = "_commit"
MANIFESTS, DATA = "_manifests", "data"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


class CommitConflict(RuntimeError):
    """Another writer committed the version first."""


# -- manifests -----------------------------------------------------------------------------------------------------------


def _files(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    if not path_exists(spark, path):
        return []
    fs, folder = _files(spark, path)
    return sorted(status.getPath().getName() for status in fs.listStatus(folder))


def versions(spark: SparkSession, target: str) -> list[int]:
    names = listed(spark, f"{target.rstrip('/')}/{MANIFESTS}")
    return [int(name[1:-5]) for name in names if re.fullmatch(r"v\d{12}\.json", name)]


def manifest(spark: SparkSession, target: str, version: int | None = None) -> dict | None:
    """The manifest of a version, the newest by default; None for a table without any."""
    found = versions(spark, target)
    if not found or version is not None and version not in found:
        if version is not None:
            raise LookupError(f"{target} has no version {version}; it has {found}")
        return None
    return json.loads(read_text(spark, f"{target.rstrip('/')}/{MANIFESTS}/v{found[-1] if version is None else version:012d}.json"))


def commit(spark: SparkSession, target: str, told: dict) -> None:
    """Make a manifest the table's next version, or raise :class:`CommitConflict`."""
    folder = f"{target.rstrip('/')}/{MANIFESTS}"
    fs, pending = _files(spark, f"{folder}/.pending-{uuid.uuid4().hex}")
    stream = fs.create(pending)
    stream.write(bytearray(json.dumps(told).encode()))
    stream.close()
    jvm = spark._jvm
    place = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{folder}/v{told['version']:012d}.json"))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    plain = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(pending), place, plain)
    except Exception as error:  # the JVM's exception, by whatever wrapper
        fs.delete(pending, False)
        if fs.exists(place):
            raise CommitConflict(f"version {told['version']} of {target} exists") from error
        raise


def committed(spark: SparkSession, target: str, change: Callable[[dict | None], dict | None], attempts: int = 20) -> int | None:
    """Apply a change to the newest manifest until it is committed; None if the change finds nothing to do."""
    for _ in range(attempts):
        newest = manifest(spark, target)
        told = change(newest)
        if told is None:
            return None
        told = {**told, "version": (newest or {"version": 0})["version"] + 1}
        try:
            commit(spark, target, told)
            return told["version"]
        except CommitConflict:
            continue
    raise CommitConflict(f"{target}: {attempts} versions were committed meanwhile")


def vacuum(spark: SparkSession, target: str, keep: int = 1, older_than_seconds: float = 86400) -> list[str]:
    """Delete all but the last ``keep`` manifests and the folders that none of those names.

    Folders younger than the limit stay: a writer may be about to commit them.
    """
    root = target.rstrip("/")
    found = versions(spark, target)
    told = [manifest(spark, target, version) for version in found[-keep:]]
    used = {folder for one in told for folder in _folders(one)}
    fs, _ = _files(spark, root)
    limit = spark._jvm.java.lang.System.currentTimeMillis() - older_than_seconds * 1000
    gone = []
    for version in found[:-keep]:
        delete_path(spark, f"{root}/{MANIFESTS}/v{version:012d}.json")
    for name in listed(spark, f"{root}/{DATA}"):
        path = f"{root}/{DATA}/{name}"
        if name not in used and fs.getFileStatus(spark._jvm.org.apache.hadoop.fs.Path(path)).getModificationTime() <= limit:
            delete_path(spark, path)
            gone.append(name)
    return gone


def _folders(told: dict) -> set[str]:
    if told["kind"] == "keyed":
        return set(told["base"].values()) | {delta["folder"] for delta in told["deltas"]}
    return {folder for day in told["days"].values() for folder in day["folders"]}


def _merged_schema(told: dict | None, schema: T.StructType) -> str:
    """A table's columns and those a batch adds; a column keeps its type."""
    fields = list(T.StructType.fromJson(json.loads(told["schema"])).fields) if told else []
    known = {field.name: field.dataType for field in fields}
    for field in schema.fields:
        if known.setdefault(field.name, field.dataType) != field.dataType:
            raise ValueError(f"column {field.name} is {known[field.name].simpleString()}, not {field.dataType.simpleString()}")
        if field.name not in {f.name for f in fields}:
            fields.append(T.StructField(field.name, field.dataType, True))
    return T.StructType(fields).json()


def _new_folder() -> str:
    return f"{COMMIT}={uuid.uuid4().hex}"


def _written(df: DataFrame, target: str, column: str) -> str:
    folder = _new_folder()
    balanced(df, column).write.option("partitionOverwriteMode", "static").partitionBy(column).parquet(
        f"{target.rstrip('/')}/{DATA}/{folder}")
    return folder


def _read(spark: SparkSession, target: str, schema: str, paths: Sequence[str], column: str, kind: T.DataType) -> DataFrame:
    """The rows below some folders of a table, with the folders' two columns."""
    full = T.StructType([*T.StructType.fromJson(json.loads(schema)).fields,
                         T.StructField(COMMIT, T.StringType()), T.StructField(column, kind)])
    if not paths:
        return spark.createDataFrame([], full)
    root = f"{target.rstrip('/')}/{DATA}"
    return spark.read.schema(full).option("basePath", root).parquet(*[f"{root}/{path}" for path in paths])


def _values(spark: SparkSession, target: str, folder: str, column: str) -> list[str]:
    """The partition values a written folder holds."""
    names = listed(spark, f"{target.rstrip('/')}/{DATA}/{folder}")
    return [name.removeprefix(f"{column}=") for name in names if name.startswith(f"{column}=")]


# -- keyed tables --------------------------------------------------------------------------------------------------------


def upsert(
    batch: DataFrame, target: str, keys: Sequence[str], order_by: str | None = None, buckets: int = 64,
    writer: str | None = None, number: int | None = None,
) -> int | None:
    """Insert or replace rows of a keyed table by adding one delta; the version, or None if there was nothing to do.

    Of several rows of one key the latest by ``order_by`` wins, over all batches; among equals, and without it, the
    later batch, and inside a batch the last as it reads.  The batch is read once.  A table's keys, order and number of
    buckets are those of its first batch.  A batch of a ``writer`` whose ``number`` is not above the writer's last one
    was committed before and changes nothing.
    """
    spark, keys = batch.sparkSession, list(keys)
    if reserved := {COMMIT, BUCKET} & set(batch.columns):
        raise ValueError(f"reserved columns: {sorted(reserved)}")
    held: dict = {}

    def delta_of(wanted: int) -> dict:
        if held.get("buckets") != wanted:
            order = [F.col(order_by).desc_nulls_last()] if order_by else []
            last = batch.withColumn(BUCKET, key_bucket(keys, wanted)).withColumn("_nth", F.monotonically_increasing_id())
            rows = latest_per_key(last, keys, *order, F.col("_nth").desc()).drop("_nth")
            folder = _written(rows, target, BUCKET)
            held.update(buckets=wanted, folder=folder, touched=[int(b) for b in _values(spark, target, folder, BUCKET)])
        return {"folder": held["folder"], "buckets": held["touched"]}

    def change(told: dict | None) -> dict | None:
        if told and (told["kind"], told["keys"], told["order_by"]) != ("keyed", keys, order_by):
            raise ValueError(f"{target} is a {told['kind']} table with keys {told.get('keys')} and order {told.get('order_by')}")
        if told and writer is not None and told["writers"].get(writer, -1) >= number:
            return None
        delta = delta_of(told["buckets"] if told else buckets)
        new = told or {"kind": "keyed", "keys": keys, "order_by": order_by, "buckets": buckets, "base": {}, "deltas": [], "writers": {}}
        writers = new["writers"] if writer is None else {**new["writers"], writer: number}
        schema = _merged_schema(told, batch.schema)
        if not delta["buckets"] and told:
            return {**new, "writers": writers, "schema": schema} if writer is not None else None
        return {**new, "deltas": [*new["deltas"], delta], "writers": writers, "schema": schema}

    return committed(spark, target, change)


def _merged(spark: SparkSession, target: str, told: dict) -> tuple[DataFrame, DataFrame]:
    """(rows of buckets no delta touches, merged rows of the others), with the bucket column.

    Base rows whose key no delta has are only passed through an anti-join, which is a broadcast while the deltas are small.
    """
    def read(paths: list[str]) -> DataFrame:
        return _read(spark, target, told["schema"], paths, BUCKET, T.IntegerType())

    touched = {bucket for delta in told["deltas"] for bucket in delta["buckets"]}
    base = {int(bucket): f"{folder}/{BUCKET}={bucket}" for bucket, folder in told["base"].items()}
    quiet = read([path for bucket, path in base.items() if bucket not in touched]).drop(COMMIT)
    if not touched:
        return quiet, quiet.limit(0)
    age = {delta["folder"].removeprefix(f"{COMMIT}="): at for at, delta in enumerate(told["deltas"], 1)}
    ages = F.create_map(*[F.lit(x) for pair in age.items() for x in pair])
    new = read([f"{d['folder']}/{BUCKET}={b}" for d in told["deltas"] for b in d["buckets"]]).withColumn("_age", ages[F.col(COMMIT)])
    old = read([path for bucket, path in base.items() if bucket in touched]).withColumn("_age", F.lit(0))
    changed = new.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(told["keys"])]).distinct()
    same = F.lit(True)
    for i, key in enumerate(told["keys"]):
        same = same & F.col(key).eqNullSafe(F.col(f"_key{i}"))
    order = []
    if told["order_by"]:
        # A base row may still be the latest; without an order it cannot.
        new = new.unionByName(old.join(changed, same, "left_semi"))
        order = [F.col(told["order_by"]).desc_nulls_last()]
    winners = latest_per_key(new, told["keys"], *order, F.col("_age").desc(), tie_break(new))
    merged = old.join(changed, same, "left_anti").unionByName(winners)
    return quiet, merged.drop(COMMIT, "_age")


def read_keyed(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    """The rows of a version of a keyed table, the newest by default; later commits do not change the frame."""
    told = manifest(spark, target, version)
    if told is None:
        raise LookupError(f"{target} has no version")
    quiet, merged = _merged(spark, target, told)
    return quiet.unionByName(merged).drop(BUCKET)


def compact(spark: SparkSession, target: str) -> int | None:
    """Merge the deltas into new base files of the buckets they touch; other buckets keep their files.

    Deltas that others commit meanwhile stay in the log and win over the new base as they did over its rows.
    """
    done: dict = {}

    def change(told: dict | None) -> dict | None:
        if not told or not told["deltas"]:
            return None
        if not done:
            folder = _written(_merged(spark, target, told)[1], target, BUCKET)
            done.update(folder=folder, buckets=_values(spark, target, folder, BUCKET), base=told["base"],
                        deltas=[delta["folder"] for delta in told["deltas"]])
        elif told["base"] != done["base"]:
            raise CommitConflict(f"{target} was compacted by another writer")
        left = [delta for delta in told["deltas"] if delta["folder"] not in done["deltas"]]
        return {**told, "base": {**told["base"], **dict.fromkeys(done["buckets"], done["folder"])}, "deltas": left}

    return committed(spark, target, change)


# -- tables by day -------------------------------------------------------------------------------------------------------


def _digest(columns: Sequence[str]) -> Column:
    """The same for the same rows in any order; repeated rows count."""
    return F.sum(F.xxhash64(*[F.col(f"`{name}`") for name in columns]).cast("decimal(38,0)")).cast("string")


def _day_read(spark: SparkSession, target: str, schema: str, days: dict, day_column: str) -> DataFrame:
    paths = [f"{folder}/{day_column}={day}" for day, facts in days.items() for folder in facts["folders"]]
    return _read(spark, target, schema, paths, day_column, T.DateType()).drop(COMMIT)


def reload_days(
    df: DataFrame, target: str, column: str, days: int, now: datetime | None = None, day_column: str = "load_day",
) -> int | None:
    """Replace the last ``days`` days of a day table by the frame's rows; the version, or None if nothing changes.

    Days of the window without rows in the frame end up empty.  Older days, and rows without a time, gain the rows
    that the frame has more often than the table: a repeated reload adds nothing and repeated rows keep their number.
    Only days whose digests differ are read.  The change is one commit.  Columns must be comparable (no maps).
    """
    spark = df.sparkSession
    start = f"{last_days_start(days, now):%Y-%m-%d}"
    folder = _written(df.withColumn(day_column, F.to_date(column)), target, day_column)
    schema = df.schema.json()
    names = [name for name in df.columns if name != day_column]
    mine = dict.fromkeys(_values(spark, target, folder, day_column), {"folders": [folder]})
    rows = _day_read(spark, target, schema, mine, day_column)
    # One row per day of the frame.
    facts = {
        NO_DAY if day is None else str(day): {"folders": [folder], "rows": n, "digest": digest}
        for day, n, digest in rows.groupBy(day_column).agg(F.count(F.lit(1)), _digest(names)).toLocalIterator()}

    def change(told: dict | None) -> dict | None:
        if told and (told["kind"], told["day_column"]) != ("days", day_column):
            raise ValueError(f"{target} is a {told['kind']} table")
        merged = _merged_schema(told, df.schema)
        held = told["days"] if told else {}
        kept = {day: old for day, old in held.items() if day == NO_DAY or day < start}
        fresh = {day: new for day, new in facts.items() if day != NO_DAY and day >= start}
        older = {day: new for day, new in facts.items() if day not in fresh}
        differ = {day for day, new in older.items() if day in kept and (new["rows"], new["digest"]) != (
            kept[day]["rows"], kept[day]["digest"])}
        added = {day: new for day, new in older.items() if day not in kept}
        added |= _lacking(spark, target, merged, kept, older, differ, day_column) if differ else {}
        days_now = {**kept, **fresh, **added}
        if told and days_now == held:
            return None
        return {"kind": "days", "day_column": day_column, "schema": merged, "days": days_now}

    return committed(spark, target, change)


def _lacking(
    spark: SparkSession, target: str, schema: str, kept: dict, mine: dict, differ: set[str], day_column: str,
) -> dict:
    """Days of the table with the rows added that a frame has more often."""
    sides = [_day_read(spark, target, schema, {day: side[day] for day in differ}, day_column).withColumn("_more", F.lit(sign))
             for side, sign in ((mine, 1), (kept, -1))]
    columns = [name for name in sides[0].columns if name != "_more"]
    surplus = sides[0].unionByName(sides[1]).groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.sum("_more").alias("_more"))
    rows = surplus.where("_more > 0").withColumn("_more", F.explode(F.expr("sequence(1L, _more)"))).drop("_more")
    folder = _written(rows, target, day_column)
    found = _values(spark, target, folder, day_column)
    grown = {day: {"folders": [*kept[day]["folders"], folder]} for day in found}
    now = _day_read(spark, target, schema, grown, day_column)
    names = [name for name in columns if name != day_column]
    return {
        day: {**grown[day], "rows": n, "digest": digest}
        for day, n, digest in ((NO_DAY if d is None else str(d), n, digest) for d, n, digest in now.groupBy(day_column).agg(
            F.count(F.lit(1)), _digest(names)).toLocalIterator())}


def read_days(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    """The rows of a version of a day table, the newest by default."""
    told = manifest(spark, target, version)
    if told is None:
        raise LookupError(f"{target} has no version")
    return _day_read(spark, target, told["schema"], told["days"], told["day_column"])
