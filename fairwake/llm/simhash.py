"""Near duplicates by SimHash: pigeonhole blocks, equality joins on them, Hamming distance.

A fingerprint has a bit for each bit of the XXH64 (seed 42) of the text's shingles that is
set in more than half of them. Two fingerprints that differ in at most `distance` bits agree
in at least three of `distance + 3` blocks, so every such pair meets under one of the
choices of three blocks (20 choices of about 32 bits for distance 3).

Only distinct fingerprints are compared; copies collapse before. Each fingerprint goes to
its 20 keys; a partition is sorted by key and read as a stream. Within a key, distances are
computed in numpy, and only links of a spanning forest leave: as many as fingerprints, not
pairs. A key with more than `HOT` fingerprints isn't gathered: its members are passed on
and split again by three blocks of the bits that the key leaves open. What then shares a
key differs in at most 17 bits, so it has a size bound whatever the corpus.

Components of the links are found by alternating stars (`components`).

NULL texts are empty; texts without a word have fingerprint 0 and are linked like any
other. NULL ids are carried and never name a component (unless it has no other id). Very
long texts are hashed whole, `WINDOWS` shingles at a time; repeated rows share a fingerprint
and a component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairwake.llm.common import fresh, small_batches, text_of, written
from fairwake.llm.components import roots

SHINGLE = 3
DISTANCE = 3
SEED = 42
HOT = 4096
WINDOWS = 1 << 15  # shingles of a text that are in memory at once
SMALL = 8  # keys with so many fingerprints are compared by offset, larger ones as a forest


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit number."""
    # bytes: lower() changes A-Z only, split() splits at space and the controls 9 to 13
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    body = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    span = min(shingle, len(words))
    total = len(words) - span + 1
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, total, WINDOWS):
        end = min(at + WINDOWS, total)
        hashes = [digest(body[a : b - 1], SEED) for a, b in zip(starts[at:end], starts[at + span : end + span])]
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8), bitorder="little")
        counts += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    marks = np.packbits(2 * counts > total, bitorder="little")
    return int(marks.view("<i8")[0])


def fingerprints(text: Column, df: DataFrame, shingle: int = SHINGLE) -> Column:
    small_batches(df.sparkSession)

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return of(text)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _blocks(bits: list[int], count: int) -> list[int]:
    """`count` masks that share the given bits evenly."""
    return [sum(1 << b for b in part.tolist()) for part in np.array_split(np.array(bits), count)]


def choices(distance: int = DISTANCE, within: int = (1 << 64) - 1) -> list[int]:
    """Masks of three blocks each; a pair within the distance agrees under at least one."""
    blocks = _blocks([b for b in range(64) if within >> b & 1], distance + 3)
    return [sum(c) for c in combinations(blocks, 3)]


def _forest(points: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that join all points reachable in steps of at most `distance` bits."""
    out, rest, todo = [], points, []
    while len(rest):
        if not todo:
            todo, rest = [rest[0]], rest[1:]
            continue
        point = todo.pop()
        near = np.bitwise_count(rest ^ point) <= distance
        found = rest[near]
        if len(found):
            out.append((np.full(len(found), point), found))
            todo.extend(found)
            rest = rest[~near]
    return out


def _linked(keys: np.ndarray, points: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links within runs of equal keys (rows of `keys`)."""
    if len(points) < 2:
        return []
    starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
    lengths = np.diff(np.append(starts, len(points)))
    run = np.repeat(np.arange(len(starts)), lengths)
    small = (lengths <= SMALL)[run]
    out = []
    for step in range(1, min(int(lengths.max()), SMALL)):
        at = np.flatnonzero((run[step:] == run[:-step]) & small[:-step])
        near = np.bitwise_count(points[at] ^ points[at + step]) <= distance
        out.append((points[at][near], points[at + step][near]))
    for i in np.flatnonzero(lengths > SMALL):
        out += _forest(points[starts[i] : starts[i] + lengths[i]], distance)
    return out


def links_within(keyed: DataFrame, distance: int, hot: int | None) -> DataFrame:
    """(choice, key, point) -> links (a, b, choice); b is NULL for members of keys above `hot`."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def frame(pairs):
            if pairs:
                a, b = (np.concatenate(x).view(np.int64) for x in zip(*pairs))
                return pd.DataFrame({"a": a, "b": pd.array(b, dtype="Int64"), "choice": 0})
            return pd.DataFrame({"a": [], "b": [], "choice": []})

        def passed(keys, points):
            return pd.DataFrame(
                {"a": points.view(np.int64), "b": pd.array([None] * len(points), dtype="Int64"), "choice": keys[:, 0]}
            )

        keys, points = np.empty((0, 2), dtype=np.int64), np.empty(0, dtype=np.uint64)
        over = None  # the key whose members are being passed on
        for batch in batches:
            keys = np.concatenate([keys, batch[["choice", "key"]].to_numpy(np.int64)])
            points = np.concatenate([points, batch["point"].to_numpy(np.int64).view(np.uint64)])
            if over is not None:
                n = int((keys == over).all(axis=1).argmin()) if not (keys == over).all() else len(keys)
                if n:
                    yield passed(keys[:n], points[:n])
                    keys, points = keys[n:], points[n:]
                if len(keys):
                    over = None
            if not len(keys):
                continue
            tail = len(keys) - int((keys[::-1] == keys[-1]).all(axis=1).argmin()) if (keys != keys[-1]).any() else 0
            head_keys, head_points = keys[:tail], points[:tail]
            if hot is not None:  # whole keys above the limit inside this batch
                starts = np.flatnonzero(np.concatenate([[True], (head_keys[1:] != head_keys[:-1]).any(axis=1)])) if tail else []
                lengths = np.diff(np.append(starts, tail)) if tail else np.empty(0, int)
                large = np.repeat(lengths > hot, lengths) if tail else np.empty(0, bool)
                if large.any():
                    yield passed(head_keys[large], head_points[large])
                    head_keys, head_points = head_keys[~large], head_points[~large]
            yield frame(_linked(head_keys, head_points, distance))
            keys, points = keys[tail:], points[tail:]
            if hot is not None and len(points) > hot:
                over = keys[0].copy()
                yield passed(keys, points)
                keys, points = keys[:0], points[:0]
        yield frame(_linked(keys, points, distance))

    return (
        keyed.repartition("choice", "key")
        .sortWithinPartitions("choice", "key")
        .mapInPandas(read, "a long, b long, choice int")
    )


def near_links(distinct: DataFrame, distance: int = DISTANCE, hot: int = HOT) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column `point`), enough for components."""
    masks = choices(distance)

    def keyed(rows: DataFrame, first: int, options: list[int]) -> DataFrame:
        keys = F.array(
            *(
                F.struct(F.lit(first + i).alias("choice"), F.col("point").bitwiseAND(F.lit(_signed(m))).alias("key"))
                for i, m in enumerate(options)
            )
        )
        return rows.select("point", F.explode(keys).alias("k")).select("k.choice", "k.key", "point")

    found = written(links_within(keyed(distinct, 0, masks), distance, hot), "simhash-links")
    links = found.where("b IS NOT NULL").select("a", "b")
    crowded = [r["choice"] for r in found.where("b IS NULL").select("choice").distinct().collect()]  # 20 at most
    for choice in sorted(crowded):
        rows = found.where(F.col("b").isNull() & (F.col("choice") == choice)).select(F.col("a").alias("point"))
        open_bits = ((1 << 64) - 1) & ~masks[choice]
        finer = [masks[choice] | m for m in choices(distance, open_bits)]
        links = links.union(links_within(keyed(rows, 0, finer), distance, None).select("a", "b"))
    return links


def near_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    hot: int = HOT,
) -> DataFrame:
    """One row per document: doc_id, fingerprint (long), component_id, text_hash."""
    small_batches(docs.sparkSession)
    rows = written(
        docs.select(
            F.col(id_column).alias("doc_id"),
            fingerprints(text_of(text_column), docs, shingle).alias("point"),
            F.xxhash64(text_of(text_column)).alias("text_hash"),
        ),
        "simhash-rows",
    )
    distinct = written(rows.groupBy("point").agg(F.min("doc_id").alias("lead")), "simhash-points")
    stars = roots(near_links(distinct, distance, hot))
    rooted = written(
        distinct.join(stars, F.col("point") == F.col("node"), "left").select(
            "point", "lead", F.coalesce("root", "point").alias("root")
        ),
        "simhash-rooted",
    )
    # written, so that a component with very many fingerprints can be split in the join
    names = written(rooted.groupBy("root").agg(F.min("lead").alias("component_id")), "simhash-names")
    named = rooted.join(names, "root")
    return rows.join(named.select("point", "component_id"), "point").select(
        "doc_id", F.col("point").alias("fingerprint"), "component_id", "text_hash"
    )


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows whose id names their component, with all columns; rows without an id stay."""
    groups = near_groups(docs, id_column, text_column)
    leave = written(
        groups.where("doc_id IS NOT NULL AND doc_id <> component_id").select("doc_id", "text_hash").distinct(),
        "simhash-leave",
    ).toDF("leave_id", "leave_hash")
    key = fresh(docs, "text_hash")
    hashed = docs.withColumn(key, F.xxhash64(text_of(text_column)))
    match = (hashed[id_column] == leave["leave_id"]) & (hashed[key] == leave["leave_hash"])
    return hashed.join(leave, match, "left_anti").drop(key)
