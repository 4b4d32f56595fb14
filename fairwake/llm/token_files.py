"""Token ids of documents in ORC files, in the order of document ids.

Rows are range-partitioned by document id, sorted within each partition, tokenised there and
written, one file to a task. A row holds doc_id, the ids as a list of integers (ORC packs
them with its integer run-length encoding), their number, the file's number and how many
ids stand before the row in its file. Each file carries min and max of doc_id for every
stripe and every `STRIDE` rows (row index) and a Bloom filter on doc_id, so a reader that
asks for some documents skips files' stripes and row groups by metadata alone. Stripes are
cut by size, and Spark reads the stripes of one file in several tasks.

A document's place among all ids needs the sums of the earlier files only: they are read
back from the narrow columns of the files, one row to a file, and joined by file number
(Spark broadcasts them if their size allows it).

Ids come from `tokens.Encoder`, as the `tokenizers` library gives them, with an end mark
after each document. NULL and empty texts are an end mark only; a very long text is one
row and one value of its list. NULL ids come first. Rows that share an id follow each other
by the hash of their text and then by their place in the input; the place is also part of
the range key, so an id that holds a third of all rows is spread over files. Other columns,
whatever their names, are not read. An empty table gives files without rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairwake.llm.common import text_of, written
from fairwake.llm.tokens import by_bytes, encoder

END = 0
STRIDE = 2000  # rows of a row group in the index
STRIPE_BYTES = 64 << 20
FALSE_POSITIVES = 0.01
SORT = ["doc_id", "tie", "row"]


def _schema(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("file", T.IntegerType()),
            T.StructField("before", T.LongType()),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
        ]
    )


def write_ids(
    docs: DataFrame,
    tokenizer: str,
    path: str,
    files: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Write the ids of all documents as ORC below `path`, in `files` files at most.

    Without `files`, the session's shuffle partitions bound their number and adaptive
    execution joins small neighbours.
    """
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        text_of(text_column).alias("text"),
        F.xxhash64(text_of(text_column)).alias("tie"),
        F.monotonically_increasing_id().alias("row"),
    )
    ranged = rows.repartitionByRange(*([files] if files else []), *SORT).sortWithinPartitions(*SORT)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, before = TaskContext.get().partitionId(), 0
        for batch in by_bytes(batches, "text"):
            ids, offsets = encoder(tokenizer).encode(batch.column("text"), END)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_tokens": np.diff(offsets),
                    "file": np.full(len(batch), file, dtype=np.int32),
                    "before": before + offsets[:-1],
                    "ids": pa.ListArray.from_arrays(offsets.astype(np.int32), ids.astype(np.int32)),
                }
            )
            before += int(offsets[-1])

    (
        ranged.select("doc_id", "text")
        .mapInArrow(read, _schema(rows.schema["doc_id"].dataType))
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", str(FALSE_POSITIVES))
        .option("orc.row.index.stride", str(STRIDE))
        .option("orc.stripe.size", str(STRIPE_BYTES))
        .option("compression", "zstd")
        .orc(path)
    )


def read_ids(spark: SparkSession, path: str, id_type: str | T.DataType = "bigint") -> DataFrame:
    """One row per document: doc_id, n_tokens, file, before, ids. Filters on doc_id reach the files."""
    if isinstance(id_type, str):
        id_type = T.StructType.fromDDL(f"doc_id {id_type}")["doc_id"].dataType
    return spark.read.schema(_schema(id_type)).orc(path)


def file_starts(stored: DataFrame) -> DataFrame:
    """For each file, how many ids the earlier files hold. Only two narrow columns are read."""
    sums = stored.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    starts = sums.selectExpr(  # one row to a file
        "file",
        "coalesce(sum(n) OVER (ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier",
    )
    return written(starts, "orc-starts")


def with_start(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """`rows` (with file and before) and the number of ids before each in all files, `start`."""
    return rows.join(file_starts(stored), "file").withColumn("start", F.col("earlier") + F.col("before"))


def checksums(stored: DataFrame) -> DataFrame:
    """The stored rows with `n_tokens` and `ids_crc32` taken from the ids themselves."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            data = memoryview(ids.values.to_numpy(zero_copy_only=False).astype("<u4")).cast("B")
            ends = ids.offsets.to_numpy().astype(np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_tokens": np.diff(ends),
                    "file": batch.column("file"),
                    "before": batch.column("before"),
                    "ids_crc32": [
                        zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())
                    ],
                }
            )

    fields = [f for f in stored.schema.fields if f.name != "ids"]
    schema = T.StructType([*fields, T.StructField("ids_crc32", T.LongType())])
    return stored.select("doc_id", "n_tokens", "file", "before", "ids").mapInArrow(read, schema)
