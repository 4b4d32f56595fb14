"""Parquet tables: day-partitioned loads, guarded scans, full rebuilds.

A loaded table is a directory of loads, `load=<id>/date=<day>/`. A load counts from the
moment its folder has the marker `_SUCCESS`, which is written last. Scans, and so
watermarks, see complete loads only. A load's id is the watermark it started from, so after
a load that died half-way the next one has the same id and replaces its files.

Scans prune by day; those of loaded tables must name the first day they want. A rebuilt
table is written beside the one before, as a new version; readers take the newest complete
version.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import tempfile
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairwake.schemas import conform

LOAD, DAY, VERSION = "load", "date", "version"
COMPLETE = "_SUCCESS"
VERSIONS_KEPT = 2  # of a rebuilt table: the new one, and the one that readers may still use
EVERY_DAY = dt.date(1900, 1, 1)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, from the session's spark.checkpoint.dir.

    Where it is unset, a session that runs in one local process gets a new temporary
    folder; a cluster session must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="fairwake-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder below the shared one that no other run uses."""
    return unused(f"{shared_folder(spark)}/{name}")


def unused(path: str) -> str:
    """A path like this one that no other run uses."""
    return f"{path}-{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{os.urandom(4).hex()}"


def scan_since(df: DataFrame, day: str, since: dt.datetime | dt.date) -> DataFrame:
    """Rows of a raw source whose day column lies after the watermark.

    The day compares with the watermark at midnight, so only whole later days load.
    """
    return df.where(F.col(day).cast("timestamp") > F.lit(since).cast("timestamp"))


def scan_table(
    spark: SparkSession, path: str, schema: T.StructType, first_day: dt.date
) -> DataFrame:
    """Rows of a table's complete loads from `first_day` on; empty if there is none."""
    loads = complete(spark, path, LOAD)
    if not loads:
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(_stored(schema)).option("basePath", path).parquet(*loads)
    return conform(stored.where(F.col(DAY) >= F.lit(first_day)), schema)


def _files(spark: SparkSession, path: str):
    """The file system of a path and the class of its paths."""
    path_class = spark._jvm.org.apache.hadoop.fs.Path
    return path_class(path).getFileSystem(spark._jsc.hadoopConfiguration()), path_class


def complete(spark: SparkSession, path: str, kind: str) -> list[str]:
    """Folders `<kind>=...` below a path that carry the marker, in the order of their names."""
    files, path_class = _files(spark, path)
    found = files.globStatus(path_class(f"{path}/{kind}=*/{COMPLETE}"))
    return sorted(status.getPath().getParent().toString() for status in found or [])


def exists(spark: SparkSession, path: str) -> bool:
    files, path_class = _files(spark, path)
    return files.exists(path_class(path))


def mark_complete(spark: SparkSession, folder: str) -> None:
    """Write the marker; Spark's own writers do so too, unless they are told not to."""
    files, path_class = _files(spark, folder)
    files.createNewFile(path_class(f"{folder}/{COMPLETE}"))


def unmark(spark: SparkSession, folder: str) -> None:
    files, path_class = _files(spark, folder)
    files.delete(path_class(f"{folder}/{COMPLETE}"), False)


def write_note(spark: SparkSession, path: str, content: dict) -> None:
    """Write a small JSON file at once: it is there as a whole or not at all."""
    files, path_class = _files(spark, path)
    draft = path_class(unused(path))
    stream = files.create(draft)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()
    if not files.rename(draft, path_class(path)):  # another run was first
        files.delete(draft, False)


def read_note(spark: SparkSession, path: str) -> dict | None:
    files, path_class = _files(spark, path)
    if not files.exists(path_class(path)):
        return None
    stream = files.open(path_class(path))
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def append_load(
    df: DataFrame, path: str, load_id: str, schema: T.StructType, *, day: Column, cluster: list[str]
) -> None:
    """Write one load, a directory per day, sorted within files by the cluster columns.

    Rows are rebalanced by day: adaptive execution splits a day that is larger than the
    advisory partition size over several tasks, whichever vessels it consists of, and
    puts small days together.
    """
    spark, folder = df.sparkSession, f"{path}/{LOAD}={load_id}"
    unmark(spark, folder)  # while it is replaced, it does not count
    rows = conform(df, schema).withColumn(DAY, day)
    (
        rows.hint("rebalance", DAY)
        .sortWithinPartitions(DAY, *cluster)
        .write.mode("overwrite")
        .partitionBy(DAY)
        .parquet(folder)
    )
    mark_complete(spark, folder)


def rebuild(df: DataFrame, path: str, cluster: list[str]) -> None:
    """Write a table anew, sorted within files by the cluster columns, as its next version."""
    spark = df.sparkSession
    stamp = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{os.urandom(4).hex()}"
    folder = f"{path}/{VERSION}={stamp}"
    df.sortWithinPartitions(*cluster).write.parquet(folder)
    mark_complete(spark, folder)
    files, path_class = _files(spark, path)
    for old in complete(spark, path, VERSION)[:-VERSIONS_KEPT]:
        files.delete(path_class(old), True)


def scan_rebuilt(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest complete version of a rebuilt table; empty if there is none."""
    versions = complete(spark, path, VERSION)
    if not versions:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(versions[-1])


def create_once(df: DataFrame, path: str) -> None:
    """Write a table unless it exists."""
    df.write.mode("ignore").parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Append a few rows, such as log entries."""
    df.coalesce(1).write.mode("append").parquet(path)


def load_id(since: dt.datetime) -> str:
    return f"{since:%Y%m%dT%H%M%S%f}"


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _stored(schema: T.StructType) -> T.StructType:
    """Columns in the files: the day is always there as the directory name."""
    fields = [f for f in schema.fields if f.name != DAY]
    return T.StructType([*fields, T.StructField(LOAD, T.StringType()), T.StructField(DAY, T.DateType())])
