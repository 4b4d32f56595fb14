"""What the text operators share: the written intermediate tables and safe column names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Python workers get at most so many rows of text, and about so many bytes, at a time.
ARROW_ROWS = 512
ARROW_BYTES = 8 << 20

A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed vocabulary file is; every executor has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch of texts holds in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local session without one gets its own."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context._jsc.sc().getCheckpointDir().getOrElse(None)
    if folder:
        return str(folder).rstrip("/")
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="fairwake-")
    context.setCheckpointDir(folder)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; what is written there goes when the driver ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(place)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of `df`, written below the shared folder and read from there.

    Later steps then start from files that survive lost executors, and values that a
    second computation could change (row numbers, sampling) are fixed.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name near `name` that `df` does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(column: str | Column) -> Column:
    """The text, empty for NULL."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))
