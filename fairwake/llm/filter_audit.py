"""How text filters interact: what each order of applying them removes, keeps and repeats.

Each document gets a mask with a bit for every filter it fails, whatever the others say.
Documents are counted in cells, by part and mask, with those that are good or toxic: 32
cells for five filters. All else is a function of the cells. The subsets of filters are
walked in Gray-code order, so one filter is toggled at a time; each cell's counter of
active failures goes up or down by one, and when it leaves or reaches zero the cell's
counts leave or join the running survivors. The survivors of all 32 subsets are stored, and
every step of every order is a difference of two of them.

Texts are measured where they are read, on their bytes, and leave the scan as 16 bytes of
digest. What failed filter E is decided by the smallest id of each digest, found by an
aggregate that combines before the shuffle; rows meet it by digest and id, so rows of one
text do not share a key, and repeated rows are counted together first. Cells are as many as
parts times 32; parts are walked apart.

NULL texts are empty; a NULL language is the empty one. A NULL id is never larger than
another nor smaller, so such rows do not fail E, and they have no labels. Rows that repeat
an id with its text do not make each other fail. Of several label rows of an id, any that
says so makes it good or toxic. An empty table has no parts and gives no rows. Very long
texts are measured whole; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import permutations
from math import factorial
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairwake.llm.common import text_of, written
from fairwake.llm.tokens import by_bytes

MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 3
SYMBOLS = b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HAS_SYMBOL = re.compile(rb"[#$%&*|]")


class Text(NamedTuple):
    """What filters look at: the text's bytes, its words and its number of characters."""

    body: bytes
    words: list[bytes]
    points: int


# Filters that look at a text alone: letter -> whether the text fails. E follows them.
TEXT_FILTERS: dict[str, Callable[[Text], bool]] = {
    "A": lambda t: len(t.words) < MIN_WORDS,
    "B": lambda t: 100 * len(set(t.words)) < MIN_DISTINCT_PERCENT * len(t.words),
    "C": lambda t: 100 * (len(t.body) - len(t.body.translate(None, CAPITALS))) > MAX_CAPITAL_PERCENT * t.points,
    "D": lambda t: HAS_SYMBOL.search(t.body) is not None,
}
COPY = "E"
FILTERS = "".join(TEXT_FILTERS) + COPY
COUNTS = ("n", "good", "toxic")


# ---- cells ---------------------------------------------------------------------------


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask (without E) and digest of each document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            texts = batch.column("text")
            masks, digests = [], []
            for body, points in zip(texts.cast(pa.binary()).to_pylist(), pc.utf8_length(texts).to_pylist()):
                # bytes split at space and the controls 9 to 13
                text = Text(body, body.split(), points)
                masks.append(sum(fails(text) << i for i, fails in enumerate(TEXT_FILTERS.values())))
                digests.append(hashlib.blake2b(body, digest_size=16).digest())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "part": batch.column("part"),
                    "mask": pa.array(masks, pa.int32()),
                    "digest": pa.array(digests, pa.binary()),
                }
            )

    rows = docs.select(
        "doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text_of("text").alias("text")
    )
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("part", T.StringType()),
            T.StructField("mask", T.IntegerType()),
            T.StructField("digest", T.BinaryType()),
        ]
    )
    return rows.mapInArrow(read, schema)


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask) -> n, good, toxic, for documents (doc_id, text, lang) and their labels."""
    rows = written(
        measured(docs).groupBy("doc_id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n")), "filter-rows"
    )
    firsts = rows.groupBy(F.col("digest").alias("of")).agg(F.min("doc_id").alias("first"))
    is_first = (F.col("digest") == F.col("of")) & (F.col("doc_id") == F.col("first"))
    is_copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    flags = labels.groupBy(F.col("doc_id").alias("labelled")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    flagged = rows.join(firsts, is_first, "left").join(flags, F.col("doc_id") == F.col("labelled"), "left")
    counted = {"n": F.col("n")} | {c: F.col("n") * F.coalesce(c, F.lit(0)) for c in COUNTS[1:]}
    return (
        flagged.withColumn("mask", F.col("mask") + is_copy.cast("int") * F.lit(1 << len(TEXT_FILTERS)))
        .groupBy("part", "mask")
        .agg(*(F.sum(c).cast("long").alias(name) for name, c in counted.items()))
    )


# ---- the walk ------------------------------------------------------------------------


def survivors(counts: dict[int, tuple[int, ...]], filters: int = len(FILTERS)) -> list[tuple[int, ...]]:
    """What passes all filters of each subset (by its bits), from mask -> counts."""
    masks = list(counts)
    active = dict.fromkeys(masks, 0)
    running = [sum(column) for column in zip(*counts.values())] or [0] * len(COUNTS)
    states: list[tuple[int, ...]] = [()] * (1 << filters)
    states[0] = tuple(running)
    subset = 0
    for turn in range(1, 1 << filters):
        toggled = turn & -turn  # the Gray code changes the bit that is the lowest of its counter
        subset ^= toggled
        change = 1 if subset & toggled else -1
        for mask in masks:
            if not mask & toggled:
                continue
            before = active[mask]
            active[mask] += change
            if 0 in (before, active[mask]):
                running = [r - change * c for r, c in zip(running, counts[mask])]
        states[subset] = tuple(running)
    return states


def steps(counts: dict[int, tuple[int, ...]], filters: str = FILTERS) -> list[tuple]:
    """Each order's steps: order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    states = survivors(counts, len(filters))
    every = len(states) - 1
    bits = {f: 1 << i for i, f in enumerate(filters)}
    fails, alone, shapley = {}, {}, {}
    for f, bit in bits.items():
        fails[f] = states[0][0] - states[bit][0]
        alone[f] = states[every ^ bit][0] - states[every][0]
        # an order with the subset before f, in some order, and the others after it
        shapley[f] = sum(
            factorial(s.bit_count()) * factorial(len(filters) - 1 - s.bit_count()) * (states[s][0] - states[s | bit][0])
            for s in range(len(states))
            if not s & bit
        )
    out = []
    for order in permutations(filters):
        subset = 0
        for step, f in enumerate(order, 1):
            before, after = states[subset], states[subset | bits[f]]
            subset |= bits[f]
            removed, good, toxic = (b - a for b, a in zip(before, after))
            out.append(
                ("".join(order), step, after[0], removed, fails[f] - removed, alone[f], good, toxic, shapley[f])
            )
    return out


COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, with the counts of COLUMNS."""

    def walk(part: pd.DataFrame) -> pd.DataFrame:  # the cells of one part, 32 at most
        counts = {int(r.mask): (int(r.n), int(r.good), int(r.toxic)) for r in part.itertuples()}
        out = pd.DataFrame(steps(counts), columns=["filter_order", "step", *COLUMNS])
        out.insert(0, "part", part["part"].iloc[0])
        return out

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COLUMNS)
    return cells(docs, labels).groupBy("part").applyInPandas(walk, schema)
