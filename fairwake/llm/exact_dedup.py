"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Texts are compared without white space (space and the controls 9 to 13). Two reads of the
table suffice, and no text is shuffled:

1. Length and prefix hash of each text are counted together (a prefix only ever meets
   prefixes of its own length). Keys seen once are settled: those texts are unique.
2. The keys seen again are counted and marked in a bit set of `SPREAD` slots for each of
   them, so few unique texts hit a marked slot by chance. The set has `MAX_SLOTS` at most,
   64 to a row, which bounds what is broadcast. Only texts that hit a slot are hashed in
   full; one that does by chance just gets its own full hash.

The survivors' narrow rows are then grouped by full hash. Groups combine before the shuffle
and are written; the join back is an ordinary equi join, which adaptive execution splits if
one group holds a large share of the rows.

Texts are read whole however long they are, and an empty table gives no rows.

NULL texts count as empty, and empty texts form one group. NULL ids are carried and come
last among ties. Of rows with the same id and text one stays. Other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairwake.llm.common import fresh, text_of, written

WHITE_SPACE = " \t\n\x0b\x0c\r"
PREFIX = 256
SPREAD = 16
# A row of the bit set takes about 40 bytes of a broadcast, so at most some 40 MB.
MAX_SLOTS = 1 << 26


def normalised(text: str | Column) -> Column:
    """The text without white space; byte-wise replacement is faster here than a pattern."""
    body = text_of(text)
    for character in WHITE_SPACE:
        body = F.replace(body, F.lit(character), F.lit(""))
    return body


class Slots(NamedTuple):
    """A bit set of `number` slots; `table` has a row (word, bits) for 64 of them, if any is marked."""

    table: DataFrame
    number: int


def slot_of(body: str, prefix: int, number: int) -> Column:
    """The slot that the length and the prefix hash of a compared text fall into."""
    head = F.xxhash64(F.left(body, F.lit(prefix)))
    return F.pmod(F.xxhash64(F.octet_length(body), head), F.lit(number))


def _bit(slot: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63).cast("long")).cast("int"))


def _word(slot: Column) -> Column:
    return F.shiftright(slot, 6)


def repeated_slots(
    docs: DataFrame, text_column: str = "text", prefix: int = PREFIX, slots: int | None = None
) -> Slots:
    """The slots of lengths and prefix hashes that several texts have."""
    body = docs.select(normalised(text_column).alias("body"))
    heads = body.select(F.octet_length("body").alias("size"), F.xxhash64(F.left("body", F.lit(prefix))).alias("head"))
    keys = written(heads.groupBy("size", "head").count().where("count > 1").select("size", "head"), "exact-heads")
    number = slots or min(MAX_SLOTS, max(64, 1 << (SPREAD * keys.count()).bit_length()))
    slot = F.pmod(F.xxhash64("size", "head"), F.lit(number))
    words = keys.select(_word(slot).alias("word"), _bit(slot).alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    return Slots(written(words, "exact-slots"), number)


def exact_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    prefix: int = PREFIX,
    slots: int | None = None,
    hash_all: bool = False,
    again: Slots | None = None,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, full_hash.

    The longest original text stays, then the smallest id. full_hash is the SHA-256 of the
    compared text; it is NULL for texts that were settled before it was needed, unless
    `hash_all` asks for all of them. `again` takes `repeated_slots` of the same rows where
    the caller has them already.
    """
    if again is None:
        again = repeated_slots(docs, text_column, prefix, slots)
    shaped = docs.select(
        F.col(id_column).alias("doc_id"),
        F.char_length(text_of(text_column)).alias("points"),
        normalised(text_column).alias("body"),
    ).withColumn("slot", slot_of("body", prefix, again.number))
    hit = F.coalesce(F.col("bits").bitwiseAND(_bit(F.col("slot"))) != 0, F.lit(False))
    narrow = written(
        shaped.withColumn("word", _word(F.col("slot")))
        .join(F.broadcast(again.table), "word", "left")
        .select(
            "doc_id",
            "points",
            hit.alias("hit"),
            F.when(F.lit(hash_all) | hit, F.sha2("body", 256)).alias("full_hash"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "exact-rows",
    )
    # written, so that the join below has a shuffle of its own on either side that can be split
    groups = written(
        narrow.where("hit")
        .groupBy("full_hash")
        .agg(
            F.count(F.lit(1)).alias("group_size"),
            F.min(F.struct(-F.col("points"), F.col("doc_id").isNull(), "doc_id", "row")).alias("keep"),
        )
        .where("group_size > 1")
        .select(F.col("full_hash").alias("key"), "group_size", "keep"),
        "exact-keys",
    )
    # rows without a full hash get a key of their own, so they do not meet in one task
    own = F.coalesce("full_hash", F.col("row").cast("string"))
    return (
        narrow.withColumn("key", own)
        .join(groups, "key", "left")
        .select(
            "doc_id",
            F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
            (F.col("keep").isNull() | (F.col("keep.row") == F.col("row"))).alias("kept"),
            "full_hash",
        )
    )


def without_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns.

    Texts whose slot no other text has pass straight through. Only the others are hashed
    again and shuffled to meet the row of their group that stays; that join is a merge join
    at every size, as the list of groups grows with the rows.
    """
    again = repeated_slots(docs, text_column)
    decided = written(exact_groups(docs, id_column, text_column, again=again).where("group_size > 1"), "exact-groups")
    # how many rows have the id that stays: above 1, the id is repeated with the same text
    keeps = decided.groupBy("full_hash").agg(
        F.first("keep_id").alias("keep_id"), F.count_if(F.expr("doc_id <=> keep_id")).alias("same")
    )
    keeps = written(keeps, "exact-keeps")  # so that a group with very many rows can be split in the join

    slot, key = fresh(docs, "exact_slot"), fresh(docs, "full_hash")
    names = [docs[c] for c in docs.columns]
    placed = docs.withColumn(slot, slot_of(normalised(text_column), PREFIX, again.number))
    match = (_word(F.col(slot)) == F.col("again_word")) & (F.col("again_bits").bitwiseAND(_bit(F.col(slot))) != 0)
    marked = F.broadcast(again.table.toDF("again_word", "again_bits"))
    single = placed.join(marked, match, "left_anti").select(*names)

    hits = placed.join(marked, match, "left_semi").withColumn(key, F.sha2(normalised(text_column), 256))
    keeps = keeps.toDF("keep_key", "keep_value", "keep_same").hint("merge")
    stay = hits.join(keeps, F.col(key) == F.col("keep_key"), "left").where(
        F.col("keep_key").isNull() | docs[id_column].eqNullSafe(F.col("keep_value"))
    )
    out = single.unionByName(stay.where("keep_same IS NULL OR keep_same = 1").select(*names))
    if not decided.where("doc_id <=> keep_id AND NOT kept").isEmpty():  # same id and text: the longest stays
        length = F.char_length(text_of(docs[text_column]))
        repeats = stay.where("keep_same > 1").select(F.col(key).alias("one"), length.alias("n"), F.struct(*names).alias("r"))
        out = out.unionByName(repeats.groupBy("one").agg(F.max_by("r", "n").alias("r")).select("r.*"))
    return out
