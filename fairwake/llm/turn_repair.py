"""Repair of conversations to the grammar `(system? (user assistant)+)?`, at least cost.

A conversation is reduced to a signature: a letter for each row, its role's initial and its
fault. What the rest of a conversation costs depends only on that rest of the signature and
on the state of the grammar. So distinct signatures are sorted by their reversed letters,
which puts signatures with a common end next to each other, and are read as a stream: the
path of the last signature is kept as a stack of nodes, a new one reuses the nodes of the
end both share and adds the others. Each node of the suffix-shared automaton (DAWG) is thus
made once, with the cost-to-go and the first edit of the best audit for each grammar state;
the rest of that audit is the chosen state's in the node behind. Nodes whose costs differ by
a constant are the same to all longer signatures and share one computed step. Memory is one
path and those classes, whatever the number of conversations.

Edits and costs: Keep 0, Rerole 2 (to user or assistant), Delete 3 (the only one for blank
and duplicate rows), Insert 2; a truncated row that stays adds 1. Of the cheapest audits the
first in ASCII order is taken. In a node and state each edit leads to one place, so the
first letter decides between equal costs.

Texts are shuffled once, to meet their conversation's audit in the order of turns; the
digest of a repaired conversation is built row by row, so a conversation's texts are never
held together. Faults and signatures are found on rows without texts. A conversation is
read as a stream in one task, as its digest can only be computed in sequence; per row of a
conversation, one letter of signature and of audit is held.

NULL roles and texts are one space. Rows are ordered by turn, NULL first, then by the MD5 of
role and text; equal rows are alike. Rows without a conversation id form one conversation.
Empty and very long texts are rows like any other, an empty table gives no rows, and other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairwake.llm.common import text_of, written

WHITE_SPACE = r"[\x20\x09-\x0D]"
ENDS = (".", "!", "?")

# Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

# Grammar states: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
# state -> {initial: next state}
GRAMMAR = (
    {"s": SYSTEM, "u": USER},
    {"u": USER},
    {"a": ASSISTANT},
    {"u": USER},
)
# the one role that may be inserted or given, by state
GIVEN = ("u", "u", "a", "u")
NAMES = {"u": "user", "a": "assistant"}
FINAL = (START, ASSISTANT)
# Letters of a signature: s, u, a and o (any other role), in capitals if truncated; x must go.
MUST_GO, OTHER = "x", "o"


# ---- the automaton -------------------------------------------------------------------


@lru_cache(maxsize=None)
def behind_all() -> tuple[tuple[int, ...], str]:
    """Costs and first edits behind the last row."""
    return _inserted([0 if g in FINAL else None for g in STATES], ["" if g in FINAL else None for g in STATES])


def _inserted(costs: list[int | None], edits: list[str | None]) -> tuple[tuple[int, ...], str]:
    """Allow inserts in front; `None` is a state without another way."""
    best = list(costs)
    for _ in STATES:
        for g in STATES:
            then = best[GRAMMAR[g][GIVEN[g]]]
            if then is not None and (best[g] is None or then + INSERT < best[g]):
                best[g] = then + INSERT
    first = []
    for g in STATES:
        options = [edits[g]] if costs[g] == best[g] else []
        if best[GRAMMAR[g][GIVEN[g]]] + INSERT == best[g]:
            options.append("I")
        first.append(min(options) or ".")
    return tuple(best), "".join(first)


@lru_cache(maxsize=1 << 16)
def step(letter: str, behind: tuple[int, ...]) -> tuple[tuple[int, ...], int, str]:
    """A node in front of one with the given costs (least 0): costs, what they add, first edits."""
    costs, edits = [], []
    for g in STATES:
        options = [(behind[g] + DELETE, "D")]
        if letter != MUST_GO:
            extra, initial = TRUNCATED * letter.isupper(), letter.lower()
            options.append((behind[GRAMMAR[g][GIVEN[g]]] + REROLE + extra, "R"))
            if initial in GRAMMAR[g]:
                options.append((behind[GRAMMAR[g][initial]] + extra, "K"))
        cost, edit = min(options)
        costs.append(cost)
        edits.append(edit)
    best, first = _inserted(costs, edits)
    least = min(best)
    return tuple(c - least for c in best), least, first


class Automaton:
    """The nodes of one signature's path; following signatures reuse the end they share."""

    def __init__(self) -> None:
        costs, first = behind_all()
        self.letters = ""  # of the last signature, from its end
        self.costs = [costs]  # of the node before so many letters, less `added`
        self.added = [0]
        self.first = [first]
        self.made = 0

    def audit(self, letters: str) -> tuple[int, str]:
        """Cost and audit of the signature whose letters, from the end, are given."""
        shared = len(commonprefix([self.letters, letters]))
        for kept in (self.costs, self.added, self.first):
            del kept[shared + 1 :]
        for letter in letters[shared:]:
            costs, more, first = step(letter, self.costs[-1])
            self.costs.append(costs)
            self.added.append(self.added[-1] + more)
            self.first.append(first)
        self.made += len(letters) - shared
        self.letters = letters
        cost = self.added[-1] + self.costs[-1][START]
        out, state, node = [], START, len(letters)
        while (edit := self.first[node][state]) != ".":
            out.append(edit)
            if edit in "IR":
                state = GRAMMAR[state][GIVEN[state]]
            elif edit == "K":
                state = GRAMMAR[state][letters[node - 1].lower()]
            node -= edit != "I"
        return cost, "".join(out)


def audits(signatures: DataFrame) -> DataFrame:
    """(signature) -> (signature, cost, audit), for distinct signatures."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton()
        for batch in batches:
            found = [automaton.audit(letters) for letters in batch.column("letters").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "signature": batch.column("signature"),
                    "cost": pa.array([c for c, _ in found], pa.int64()),
                    "audit": pa.array([a for _, a in found], pa.string()),
                }
            )

    return (
        signatures.select("signature", F.reverse("signature").alias("letters"))
        .repartitionByRange("letters")
        .sortWithinPartitions("letters")
        .mapInArrow(read, "signature string, cost long, audit string")
    )


# ---- rows ----------------------------------------------------------------------------


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and `gone`, with each row's damage drawn from its key."""
    space = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    fate = turns.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("fate")
    )
    return fate.select(
        "conv_id",
        "turn",
        F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, F.lit(""))
        .when(F.col("fate") == 2, F.translate("text", "".join(ENDS), ""))
        .otherwise(F.col("text"))
        .alias("text"),
        (F.col("fate") == 0).alias("gone"),
        F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _content() -> Column:
    """What equal rows of a conversation share, in 16 bytes."""
    return F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))


def signatures(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, signature.

    `turns` has conv_id, turn, role, text and gone (the row only names its conversation).
    """
    body = F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     "))
    initial = F.substring("role", 1, 1)
    narrow = turns.select(
        "conv_id",
        "turn",
        _content().alias("content"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise(OTHER).alias("initial"),
        (body == "").alias("blank"),
        (~F.right(body, F.lit(1)).isin(*ENDS)).alias("truncated"),
        "gone",
    )
    again = F.expr("row_number() OVER (PARTITION BY conv_id, content, gone ORDER BY turn) > 1")
    letter = (
        F.when(F.col("gone"), F.lit("-"))
        .when(F.col("blank"), F.lit("b"))
        .when(again, F.lit("d"))
        .when(F.col("truncated"), F.lit("t"))
        .otherwise(F.lit("."))
    )
    rows = narrow.select("conv_id", "turn", "content", "initial", letter.alias("fault"))
    id_type = turns.schema["conv_id"].dataType
    schema = T.StructType(
        [
            T.StructField("conv_id", id_type),
            *(T.StructField(n, T.LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal")),
            T.StructField("signature", T.StringType()),
        ]
    )
    legal = {"su", "ua", "au"}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, counts, letters = None, False, {}, []
        low = high = last = None
        initial_before, distinct, illegal = "", 0, 0

        def finished() -> dict:
            return {
                "conv_id": key,
                "gaps": 0 if low is None else high - low + 1 - distinct,
                "blank": counts.get("b", 0),
                "duplicate": counts.get("d", 0),
                "truncated": counts.get("t", 0),
                "illegal": illegal,
                "signature": "".join(letters),
            }

        out_schema = None
        for batch in batches:
            if out_schema is None:
                id_field = batch.schema.field("conv_id")
                out_schema = pa.schema(
                    [id_field, *((n, pa.int64()) for n in schema.names[1:6]), ("signature", pa.string())]
                )
            out = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault"))
            for conv, turn, role, fault in zip(*columns):
                if not held or conv != key:
                    if held:
                        out.append(finished())
                    key, held, counts, letters = conv, True, {}, []
                    low = high = last = None
                    initial_before, distinct, illegal = "", 0, 0
                if fault == "-":
                    continue
                counts[fault] = counts.get(fault, 0) + 1
                letters.append(MUST_GO if fault in "bd" else role.upper() if fault == "t" else role)
                if turn is not None and turn != last:
                    low, high, last, distinct = turn if low is None else low, turn, turn, distinct + 1
                if initial_before and initial_before + role not in legal:
                    illegal += 1
                initial_before = role
            if out:
                yield pa.RecordBatch.from_pylist(out, out_schema)
        if held:
            yield pa.RecordBatch.from_pylist([finished()], out_schema)

    return (
        rows.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "content")
        .select("conv_id", "turn", "initial", "fault")
        .mapInArrow(read, schema)
    )


def digests(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of each conversation as its audit repairs it.

    Each conversation's audit comes first among its rows, then its turns in order.
    """
    head = convs.select(
        "conv_id",
        F.lit(0).alias("kind"),
        F.lit(None).cast(turns.schema["turn"].dataType).alias("turn"),
        F.lit(None).cast("binary").alias("content"),
        F.lit("").alias("role"),
        F.col("audit").alias("text"),
    )
    rows = turns.where("NOT gone").select("conv_id", F.lit(1).alias("kind"), "turn", _content().alias("content"), "role", "text")
    schema = T.StructType(
        [T.StructField("conv_id", turns.schema["conv_id"].dataType), T.StructField("repaired_sha256", T.StringType())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, audit, at, state, digest, gap = None, False, "", 0, START, None, b""

        def add(role: str, text: str) -> None:
            nonlocal gap
            digest.update(gap + f"{role}:{text}".encode())
            gap = b"\n"

        def insert() -> None:
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                given = GIVEN[state]
                add(NAMES[given], "")
                at, state = at + 1, GRAMMAR[state][given]

        out_schema = None
        for batch in batches:
            out_schema = out_schema or pa.schema([batch.schema.field("conv_id"), ("repaired_sha256", pa.string())])
            out = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "kind", "role", "text"))
            for conv, kind, role, text in zip(*columns):
                if kind == 0:
                    if held:
                        insert()
                        out.append({"conv_id": key, "repaired_sha256": digest.hexdigest()})
                    key, held, audit, at, state, digest, gap = conv, True, text, 0, START, hashlib.sha256(), b""
                    continue
                insert()
                edit, at = audit[at], at + 1
                if edit == "K":
                    add(role, text)
                    state = GRAMMAR[state][role[0]]
                elif edit == "R":
                    given = GIVEN[state]
                    add(NAMES[given], text)
                    state = GRAMMAR[state][given]
            if out:
                yield pa.RecordBatch.from_pylist(out, out_schema)
        if held:
            insert()
            yield pa.RecordBatch.from_pylist([{"conv_id": key, "repaired_sha256": digest.hexdigest()}], out_schema)

    return (
        head.union(rows)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "kind", "turn", "content")
        .select("conv_id", "kind", "role", "text")
        .mapInArrow(read, schema)
    )


def repaired(turns: DataFrame) -> DataFrame:
    """One row per conversation: its counts of faults, cost, audit and the repaired digest.

    `turns` has conv_id, turn, role, text (no NULL in the last two) and gone.
    """
    convs = written(signatures(turns), "turn-signatures")
    found = written(audits(convs.select("signature").distinct()), "turn-audits")
    audited = written(convs.join(found, "signature").drop("signature"), "turn-audited")
    shas = digests(turns, audited).withColumnRenamed("conv_id", "sha_id")
    return audited.join(shas, F.col("conv_id").eqNullSafe(F.col("sha_id"))).drop("sha_id")
