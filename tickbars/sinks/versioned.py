"""Fact tables whose readers see whole versions only.

A table is a folder of data files that are never changed, and one manifest per version: the files the version consists of,
each with its hour, row count, and first and last start and end. A version comes into being when its manifest is complete,
which the writing job marks with one file created at the very end. Readers take the newest complete version, or one they
pinned, and open only files whose bounds can match. One writer per table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.operators.facts import with_trade_hour
from tickbars.operators.merge import merge_by_key
from tickbars.sinks.tables import PARTITIONS

DATA, MANIFESTS = "data", "_versions"
BOUNDS = "first_start TIMESTAMP, last_start TIMESTAMP, first_end TIMESTAMP, last_end TIMESTAMP"
MANIFEST = f"file STRING, trade_date DATE, trade_hour INT, n_rows BIGINT, {BOUNDS}"

#: Versions that stay readable; what only older ones use is collected once there are twice as many.
KEPT_VERSIONS = 3


def _folder(spark: SparkSession, path: str):
    """(file system, path) of a folder."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), jvm_path


def versions(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """(version, batch that made it) of all complete versions, oldest first."""
    fs, root = _folder(spark, f"{path}/{MANIFESTS}")
    if not fs.exists(root):
        return []
    found = []
    for entry in fs.listStatus(root):
        if entry.isDirectory() and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS")):
            version, batch = entry.getPath().getName().split(".")
            found.append((int(version), int(batch)))
    return sorted(found)


def current(spark: SparkSession, path: str) -> int:
    """The newest complete version; 0 where there is none yet."""
    return max((v for v, _ in versions(spark, path)), default=0)


def manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The files of a version and their bounds."""
    known = dict(versions(spark, path))
    version = max(known, default=0) if version is None else version
    if version == 0:
        return spark.createDataFrame([], MANIFEST)
    if version not in known:
        raise ValueError(f"version {version} of {path} is not there (any more)")
    return spark.read.schema(MANIFEST).parquet(f"{path}/{MANIFESTS}/{version:020d}.{known[version]}")


def _data(spark: SparkSession, path: str, files: list[str], schema: T.StructType) -> DataFrame:
    if not files:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", f"{path}/{DATA}")
    return reader.parquet(*[f"{path}/{DATA}/{f}" for f in sorted(files)]).select(*schema.fieldNames())


def read(
    spark: SparkSession, path: str, schema: T.StructType, can_match: str | Column | None = None, version: int | None = None
) -> DataFrame:
    """The rows of one version. ``can_match`` is a condition on the manifest; files that fail it aren't opened.

    The driver gets the names of the files that are read, as in any scan, and nothing else. ``schema`` is that of the
    stored facts, partition columns included. The version is fixed when this is called, whatever is published later.
    """
    files = manifest(spark, path, version)
    files = files if can_match is None else files.where(can_match)
    return _data(spark, path, [r.file for r in files.select("file").collect()], schema)


def recent(spark: SparkSession, path: str, schema: T.StructType, since, version: int | None = None) -> DataFrame:
    """Rows that end at ``since`` or later, from the files that hold such rows."""
    since = since if isinstance(since, Column) else F.lit(since)
    return read(spark, path, schema, F.col("last_end") >= since, version).where(F.col("end_ts") >= since)


def _hours(rows: DataFrame) -> list[str]:
    """The hours that rows lie in, as text: few, however many the rows."""
    return [r.hour for r in with_trade_hour(rows).select(_hour().alias("hour")).distinct().collect()]


def _hour() -> Column:
    return F.concat_ws(" ", *PARTITIONS)


def in_hours(spark: SparkSession, path: str, schema: T.StructType, touched: DataFrame, version: int | None = None) -> DataFrame:
    """Rows of the hours that ``touched`` (with ``start_ts``) lies in, from the files of these hours."""
    if not versions(spark, path):
        return spark.createDataFrame([], schema)
    return read(spark, path, schema, _hour().isin(_hours(touched)), version)


def upsert(spark: SparkSession, facts: DataFrame, path: str, key: str = "bar_id", order: str | None = None, batch: int = 0) -> int:
    """Insert facts, replacing rows of the same key, and publish the result as the next version; gives its number.

    Only the hours that the batch touches are read and written anew; files of other hours go over into the new version as
    they are. Until the new manifest is complete readers see the old version, and what a failed try left behind is written
    over by the next one. A batch that is run again after it was published changes nothing, nor does one without facts.
    """
    done = versions(spark, path)
    version, last = done[-1] if done else (0, None)
    if last == batch:
        return version
    incoming = with_trade_hour(facts)
    stored = incoming.drop(order or "")
    hours = _hours(facts)
    if not hours:
        return version
    known = manifest(spark, path, version)
    touched = _hour().isin(hours)
    replaced = known.where(touched).select("file").collect()
    existing = _data(spark, path, [r.file for r in replaced], stored.schema)
    merged = merge_by_key(existing, incoming, key, order)
    new = f"version={version + 1}"
    # One task per hour and symbol: few files, each within one hour.
    parts = merged.repartition(*PARTITIONS, "symbol").sortWithinPartitions(*PARTITIONS)
    parts.write.mode("overwrite").partitionBy(*PARTITIONS).parquet(f"{path}/{DATA}/{new}")
    publish(spark, path, version, batch, stored.schema, known.where(~touched))
    if len(done) + 1 >= 2 * KEPT_VERSIONS:
        collect(spark, path)
    return version + 1


def publish(spark: SparkSession, path: str, version: int, batch: int, schema: T.StructType, kept: DataFrame) -> None:
    """Write the manifest after ``version``: ``kept`` files and those of the new data folder."""
    folder = f"{path}/{DATA}/version={version + 1}"
    rows = spark.read.schema(schema).option("basePath", f"{path}/{DATA}").parquet(folder)
    name = F.concat(F.lit(f"version={version + 1}/"), F.substring_index("_metadata.file_path", f"/version={version + 1}/", -1))
    made = rows.groupBy(name.alias("file"), *PARTITIONS).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("start_ts").alias("first_start"),
        F.max("start_ts").alias("last_start"),
        F.min("end_ts").alias("first_end"),
        F.max("end_ts").alias("last_end"),
    )
    # Complete with the file that the job creates last: this is the swap.
    whole = kept.unionByName(made)
    whole.write.mode("overwrite").parquet(f"{path}/{MANIFESTS}/{version + 1:020d}.{batch}")


def collect(spark: SparkSession, path: str, keep: int = KEPT_VERSIONS) -> None:
    """Delete data files and manifests that only versions before the last ``keep`` use."""
    done = versions(spark, path)
    if len(done) <= keep:
        return
    live = manifest(spark, path, done[-keep][0])
    for version, _ in done[-keep + 1 :]:
        live = live.unionByName(manifest(spark, path, version))
    for version, batch in done[:-keep]:
        dead = manifest(spark, path, version).join(live, "file", "left_anti").select("file")
        for row in dead.toLocalIterator():  # files that newer versions replaced
            fs, old = _folder(spark, f"{path}/{DATA}/{row.file}")
            fs.delete(old, False)
        fs, old = _folder(spark, f"{path}/{MANIFESTS}/{version:020d}.{batch}")
        fs.delete(old, True)
