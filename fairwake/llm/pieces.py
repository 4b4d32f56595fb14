"""SentencePiece encoding and decoding; giant documents by a max-plus parallel scan.

For a byte-pair model, a segmentation is the one that merging gives exactly if every two
neighbouring pieces stay as they are when their joint text is merged alone. So encoding is
a best-path problem over the pieces that occur in the text: a step from one piece to the
next weighs 0 if the two are compatible and minus infinity if not, and only one path from
the start to the end of the text has a weight of 0.

A giant document is split into chunks of characters. A chunk's boundary states are the
pieces that cross or end at the boundary (a piece has at most 16 characters, so they are
few). Its transfer matrix says which state at its end each state at its start leads to; it
needs only the chunk and some characters around it, so all chunks are done in parallel. The
product of matrices is associative; applied in order, it gives the state at each boundary.
Each chunk then traces its own pieces back between its two states, again in parallel.
Documents of ordinary length go through the same model with the library, in the task that
reads them. Both give the same ids; tests compare them.

Spaces are kept, as the model defines it, and U+2581 counts as a space. Characters without
a piece become bytes. NULL and empty texts have one chunk without ids. NULL ids and repeated
rows are carried through; rows are told apart by a number fixed when they are first written.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairwake.llm.common import small_batches, text_of, written

GIANT = 1 << 16
CHUNK = 1 << 14
SPACE = "▁"


class State(NamedTuple):
    """A piece at a boundary: it starts `back` characters before and ends `ahead` after it."""

    back: int
    ahead: int

    @property
    def code(self) -> int:
        return self.back << 8 | self.ahead

    @classmethod
    def of(cls, code: int) -> State:
        return cls(code >> 8, code & 255)


START = State(0, 0)  # before the first piece of a text


class Model:
    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.library.get_piece_size()
        names = [self.library.id_to_piece(i) for i in range(size)]
        special = [self.library.is_control(i) or self.library.is_unknown(i) for i in range(size)]
        byte = [self.library.is_byte(i) for i in range(size)]
        self.ids = {p: i for i, p in enumerate(names) if not special[i] and not byte[i]}
        self.scores = {p: self.library.get_score(i) for p, i in self.ids.items()}
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(names) if byte[i]}
        self.bytes = [
            bytes([int(p[3:5], 16)]) if byte[i] else b"" if special[i] else p.replace(SPACE, " ").encode()
            for i, p in enumerate(names)
        ]
        self.longest = max(map(len, self.ids))
        self.prefixes = {p[:n] for p in self.ids for n in range(2, len(p) + 1)}
        self.compatible_pairs: dict[tuple[str, str], bool] = {}

    def prepare(self, text: str) -> str:
        return SPACE + text.replace(" ", SPACE) if text else ""

    def merged(self, text: str) -> list[str]:
        """Byte-pair merging of a short text: the best pair first, of equal ones the leftmost."""
        parts = list(text)
        while True:
            best = max(
                ((self.scores[parts[i] + parts[i + 1]], -i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in self.scores),
                default=None,
            )
            if best is None:
                return parts
            i = -best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def compatible(self, left: str, right: str) -> bool:
        known = self.compatible_pairs.get((left, right))
        if known is None:
            if len(self.compatible_pairs) > 1_000_000:
                self.compatible_pairs.clear()
            known = self.merged(left + right) == [left, right]
            self.compatible_pairs[left, right] = known
        return known

    def ids_of(self, piece: str) -> list[int]:
        known = self.ids.get(piece)
        return [known] if known is not None else [self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")]

    def pieces_at(self, text: str, at: int) -> list[str]:
        """Pieces that start here; a character without a piece stands alone."""
        found = [text[at]]
        for end in range(at + 2, min(at + self.longest, len(text)) + 1):
            piece = text[at:end]
            if piece not in self.prefixes:
                break
            if piece in self.ids:
                found.append(piece)
        return found

    def walk(self, body: str, lo: int, hi: int, entries: list[State]) -> list[dict[str, tuple[int, tuple | None]]]:
        """Pieces by their end, reached from the entry states: a bit set and one predecessor.

        `body` has the chunk from `lo` to `hi` and its surroundings. Pieces start within the
        chunk and may end beyond it.
        """
        ends: list[dict[str, tuple[int, tuple | None]]] = [{} for _ in range(len(body) + 1)]
        for bit, state in enumerate(entries):
            piece = body[lo - state.back : lo + state.ahead]
            bits, _ = ends[lo + state.ahead].get(piece, (0, None))
            ends[lo + state.ahead][piece] = (bits | 1 << bit, None)
        for at in range(lo, hi):
            before = ends[at]
            if not before:
                continue
            for piece in self.pieces_at(body, at):
                reached, last = 0, None
                for left, (bits, _) in before.items():
                    if bits & ~reached and (not left or self.compatible(left, piece)):
                        reached |= bits
                        last = (at, left)
                if reached:
                    ends[at + len(piece)][piece] = (reached, last)
        return ends

    def boundary(self, body: str, at: int) -> list[State]:
        """All pieces that start before `at` and end there or later."""
        states = []
        for start in range(max(at - self.longest, 0), at):
            for piece in self.pieces_at(body, start):
                if start + len(piece) >= at:
                    states.append(State(at - start, start + len(piece) - at))
        return states

    def transfer(self, body: str, lo: int, hi: int, first: bool) -> list[tuple[int, int]]:
        """Pairs of codes: from which state at `lo` which state at `hi` is reached."""
        entries = [START] if first else self.boundary(body, lo)
        ends = self.walk(body, lo, hi, entries)
        pairs = []
        for end in range(hi, min(hi + self.longest, len(body) + 1)):
            for piece, (bits, last) in ends[end].items():
                if last is not None and end - len(piece) < hi:
                    out = State(hi - end + len(piece), end - hi).code
                    pairs += [(s.code, out) for i, s in enumerate(entries) if bits >> i & 1]
        return pairs

    def trace(self, body: str, lo: int, hi: int, entry: State, leave: State) -> list[int]:
        """Ids of the pieces that start within the chunk on the path between two states."""
        ends = self.walk(body, lo, hi, [entry])
        at, piece, out = hi + leave.ahead, body[hi - leave.back : hi + leave.ahead], []
        while True:
            _, last = ends[at][piece]
            if last is None:
                break
            out.append(piece)
            at, piece = last
        return [i for p in reversed(out) for i in self.ids_of(p)]

    def text(self, ids: list[int], first: bool) -> str:
        content = b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")
        return content[1:] if first and content.startswith(" ") else content


def compose(left: list[tuple[int, int]], right: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The product of two transfer matrices."""
    by_start: dict[int, list[int]] = {}
    for a, b in right:
        by_start.setdefault(a, []).append(b)
    return sorted({(a, c) for a, b in left for c in by_start.get(b, ())})


def boundary_states(matrices: list[list[tuple[int, int]]]) -> list[int]:
    """The states at all boundaries of a document, from the start to the end of its text."""
    prefix = [[(START.code, START.code)]]
    for matrix in matrices:
        prefix.append(compose(prefix[-1], matrix))
    state = next(b for _, b in prefix[-1] if State.of(b).ahead == 0)
    states = [state]
    for matrix, before in zip(reversed(matrices), reversed(prefix[:-1])):
        reachable = {b for _, b in before}
        state = next(a for a, b in matrix if b == state and a in reachable)
        states.append(state)
    return states[::-1]


_models: dict[str, Model] = {}  # of this Python worker


def model_of(path: str) -> Model:
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def encode(
    docs: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    giant: int = GIANT,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row per chunk of a document: doc_id, row, chunk, chunks, ids.

    ids are little-endian unsigned 32-bit numbers; a document's are those of its chunks in
    order. Documents of up to `giant` characters have one chunk.
    """
    small_batches(docs.sparkSession)
    chunk = max(chunk, 64)
    giant = max(giant, chunk)  # shorter texts would have no chunk

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = model_of(path)
        for batch in batches:
            short = batch["text"].str.len() <= giant
            found = iter(model.library.encode(batch["text"][short].tolist(), num_threads=1))
            rows = []
            for doc_id, row, text, whole in zip(batch["doc_id"].astype("object"), batch["row"], batch["text"], short):
                if whole:
                    rows.append((doc_id, row, 0, 1, _packed(next(found)), None, 0, 0))
                    continue
                text = model.prepare(text)
                bounds = [*range(0, len(text) - chunk // 2, chunk), len(text)]
                for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    low = max(a - model.longest, 0)
                    body = text[low : b + model.longest]
                    rows.append((doc_id, row, i, len(bounds) - 1, None, body, a - low, b - low))
            yield pd.DataFrame(rows, columns=["doc_id", "row", "chunk", "chunks", "ids", "body", "lo", "hi"])

    def transfers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = model_of(path)
        for batch in batches:
            pairs = [
                model.transfer(r.body, r.lo, r.hi, r.chunk == 0) for r in batch.itertuples(index=False)
            ]
            yield pd.DataFrame(
                {
                    "row": batch["row"],
                    "chunk": batch["chunk"],
                    "starts": [[a for a, _ in p] for p in pairs],
                    "ends": [[b for _, b in p] for p in pairs],
                }
            )

    def scan(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("chunk")
        states = boundary_states([list(zip(a, b)) for a, b in zip(group["starts"], group["ends"])])
        return pd.DataFrame({"row": group["row"], "chunk": group["chunk"], "entry": states[:-1], "leave": states[1:]})

    def traces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = model_of(path)
        for batch in batches:
            ids = [
                _packed(model.trace(r.body, r.lo, r.hi, State.of(r.entry), State.of(r.leave)))
                for r in batch.itertuples(index=False)
            ]
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"].astype("object"), "row": batch["row"], "chunk": batch["chunk"], "chunks": batch["chunks"], "ids": ids}
            )

    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.monotonically_increasing_id().alias("row"), text_of(text_column).alias("text")
    )
    id_type = rows.schema["doc_id"].dataType.simpleString()
    result = f"doc_id {id_type}, row long, chunk int, chunks int, ids binary"
    pieces = written(rows.mapInPandas(split, f"{result}, body string, lo int, hi int"), "piece-chunks")
    giants = pieces.where("chunks > 1").drop("ids")
    # a number keeps adaptive execution from putting chunks of few bytes but much work into one task
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    matrices = giants.repartition(spread, "row", "chunk").mapInPandas(
        transfers, "row long, chunk int, starts array<int>, ends array<int>"
    )
    states = written(
        matrices.groupBy("row").applyInPandas(scan, "row long, chunk int, entry int, leave int"), "piece-states"
    )
    traced = giants.join(states, ["row", "chunk"]).mapInPandas(traces, result)
    return pieces.where("chunks = 1").select("doc_id", "row", "chunk", "chunks", "ids").unionByName(traced)


def decoder(df: DataFrame, path: str):
    """A column function: (ids, chunk) -> text of the chunk."""
    small_batches(df.sparkSession)

    @F.pandas_udf("string")
    def text(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = model_of(path)
        for ids, chunk in batches:
            yield pd.Series(
                [model.text(struct.unpack(f"<{len(i) // 4}I", i), c == 0) for i, c in zip(ids, chunk)], dtype=object
            )

    return text


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of `encoded` with the text of each chunk."""
    text: Column = decoder(encoded, path)(F.col("ids"), F.col("chunk"))
    return encoded.withColumn("text", text)
