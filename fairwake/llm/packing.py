"""Packing of tokenised documents into windows, best fit decreasing.

Documents are tokenised where they are read, each with an end mark, and cut into full
windows and a rest. Full windows need no packing. Rests go, longest first, into the open
window with the smallest remaining capacity that takes them; a segment tree over the
capacities finds it.

All that best fit decreasing looks at is the lengths, and there are only as many lengths
and capacities as a window has tokens. So it runs on the counts of rests per length: pieces
of one length that go to windows of one capacity are placed together, as a range of windows.
That gives the same windows as placing pieces one by one, globally, and a table of some
thousand steps whatever the size of the corpus. A piece then finds its step by its rank
among pieces of its length. Ranks are those of the writing tasks, shifted by the counts of
earlier tasks, so neither tokens nor pieces are shuffled.

NULL and empty texts are an end mark only. NULL ids and repeated rows are carried through.
An empty table packs into nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairwake.llm.common import written
from fairwake.llm.tokens import by_bytes, encoder

WINDOW = 1024
END = 0

def _tokenised(path: str, window: int, with_ids: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ordinals = TaskContext.get().partitionId(), np.zeros(window + 1, dtype=np.int64)
        for batch in by_bytes(batches, "text"):
            ids, offsets = encoder(path).encode(batch.column("text"), END)
            ids = ids.astype("<u4")
            totals = np.diff(offsets)
            pieces = -(-totals // window)
            doc = np.repeat(np.arange(len(totals)), pieces)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
            length = np.minimum(totals[doc] - start, window)
            ends = np.cumsum(length)
            data = memoryview(ids).cast("B")
            crcs = [zlib.crc32(data[4 * (b - n) : 4 * b]) for b, n in zip(ends.tolist(), length.tolist())]
            # the n-th piece of its length in this task
            by_length = np.argsort(length, kind="stable")
            found = np.bincount(length, minlength=window + 1)
            ordinal = np.empty(len(length), dtype=np.int64)
            ordinal[by_length] = np.arange(len(length)) - np.repeat(np.cumsum(found) - found, found)
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(doc)),
                "start": start,
                "length": length,
                "ids_crc32": crcs,
                "doc_tokens": totals[doc],
                "part": np.full(len(doc), part, dtype=np.int32),
                "ordinal": ordinal + ordinals[length],
            }
            ordinals += found
            if with_ids:
                columns["ids"] = [data[4 * (b - n) : 4 * b].tobytes() for b, n in zip(ends.tolist(), length.tolist())]
            yield pa.RecordBatch.from_pydict(columns)

    return read


class SegmentTree:
    """Which capacities have open windows; finds the smallest one from a given value on."""

    def __init__(self, top: int):
        self.size = 1 << top.bit_length()
        self.open = [False] * (2 * self.size)

    def set(self, capacity: int, is_open: bool) -> None:
        at = self.size + capacity
        self.open[at] = is_open
        while at > 1:
            at //= 2
            self.open[at] = self.open[2 * at] or self.open[2 * at + 1]

    def smallest_from(self, capacity: int) -> int | None:
        at = self.size + capacity
        if self.open[at]:
            return capacity
        while at > 1:  # up until a subtree to the right has an open leaf
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                break
            at //= 2
        else:
            return None
        while at < self.size:
            at = 2 * at if self.open[2 * at] else 2 * at + 1
        return at - self.size


class Step(NamedTuple):
    """Pieces of `length` with ranks from `first` on, `each` to a window, from `sequence` on."""

    length: int
    first: int
    end: int
    sequence: int
    each: int
    offset: int


def best_fit_decreasing(counts: list[int], window: int = WINDOW) -> list[Step]:
    """Steps that place counts[n] pieces of every length n."""
    tree, ranges = SegmentTree(window), [[] for _ in range(window + 1)]
    steps, sequences = [], 0

    def reopen(capacity: int, first: int, number: int) -> None:
        if capacity and number:
            ranges[capacity].append((first, number))
            tree.set(capacity, True)

    for length in range(window, 0, -1):
        left, rank = counts[length], 0
        while left:
            capacity = tree.smallest_from(length)
            if capacity is None:
                capacity, first = window, sequences
                number = -(-left // (window // length))
                sequences += number
            else:
                first, number = ranges[capacity].pop()
                if not ranges[capacity]:
                    tree.set(capacity, False)
            # the tightest window stays the tightest until the length no longer fits
            each = min(capacity // length, left)
            used = min(number, left // each)
            steps.append(Step(length, rank, rank + used * each, first, each, window - capacity))
            rank += used * each
            left -= used * each
            reopen(capacity - each * length, first, used)
            if used < number:
                reopen(capacity, first + used, number - used)
    return steps


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    With `with_ids` also ids, as little-endian unsigned 32-bit numbers. Sequences of less
    than `window` tokens are to be padded by whoever writes them out.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    id_type = texts.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, part int, ordinal long"
        + ", ids binary" * with_ids
    )
    pieces = written(texts.mapInArrow(_tokenised(tokenizer, window, with_ids), schema), "pack-pieces")
    per_task = written(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "pack-counts")

    counts = [0] * (window + 1)
    for row in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row["length"]] = row["n"]
    by_length: dict[int, list[tuple]] = {}
    for step in best_fit_decreasing(counts, window):
        by_length.setdefault(step.length, []).append(tuple(step)[1:])
    steps = spark.createDataFrame(
        list(by_length.items()),
        "length bigint, steps array<struct<first:bigint,end:bigint,sequence:bigint,each:bigint,offset:bigint>>",
    )
    before = per_task.selectExpr(
        "part",
        "length",
        "coalesce(sum(n) OVER (PARTITION BY length ORDER BY part"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before",
    )
    ranked = pieces.join(before, ["part", "length"]).withColumn("rank", F.col("ordinal") + F.col("before"))
    placed = ranked.join(F.broadcast(steps), "length").withColumn(
        "step", F.get(F.filter("steps", lambda s: (F.col("rank") >= s["first"]) & (F.col("rank") < s["end"])), F.lit(0))
    )
    place = F.col("rank") - F.col("step.first")
    return placed.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        F.expr("step.sequence + (rank - step.first) div step.each").alias("sequence_id"),
        (F.col("step.offset") + place % F.col("step.each") * F.col("length")).alias("offset"),
        *(["ids"] if with_ids else []),
    )
