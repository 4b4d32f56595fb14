"""Secret scan: fixed rules, and formats learned from the credentials that the rules find.

Three rules (assignments to a telling name, access keys, long hex numbers) give labelled
credentials. For each kind, and for other long tokens of the corpus, a probabilistic
automaton is inferred: the values form a prefix tree with counts, and states are merged
while their stop and next-character frequencies differ no more than chance would explain
(Hoeffding bound, all the way down their subtrees). Every long token with digits and
letters is then scored under each automaton; if a credential format is likelier than the
ordinary tokens by `MARGIN` per character, the token is a span of kind `format`.

Training takes `SAMPLE` distinct values per kind, those with the lowest hash, of at most
`LONGEST` characters. Each task keeps only its lowest ones, so what is shuffled and sent to
the driver is bounded. Scanning covers every whole text, row by row, without a shuffle.

NULL and empty texts have no spans. Without labelled credentials only the rules apply.
Repeated rows get the same spans. Rule spans of different kinds may overlap; `format` spans
overlap none.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairwake.llm.common import fresh, small_batches

KINDS = ("assign", "access", "hex", "format")  # in the order of equal starts
OTHER = "other"

# The rules. Names count in either case of ASCII letters.
NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")
_EITHER = "|".join(
    "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in n) for n in ("password", "passwd", "secret", "token")
) + "|[aA][pP][iI]_?[kK][eE][yY]"
ASSIGN = re.compile(rf"""({_EITHER})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")

# Access keys and long hex numbers lie within such tokens, which are rare and found first.
TOKEN_LENGTH = 16
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % TOKEN_LENGTH)
DIGIT, LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")

SAMPLE = 400
LONGEST = 128
ALPHA = 0.05
MARGIN = 0.5
SMOOTH, SYMBOLS = 0.02, 67  # added to each count; characters of a token and the stop


class Span(NamedTuple):
    start: int
    order: int  # place of the kind in KINDS
    end: int
    value: str


def rule_spans(text: str) -> tuple[list[Span], list[re.Match]]:
    """Spans of the rules, sorted, and all long tokens of the text."""
    spans = []
    low = text.lower()
    if any(name in low for name in NAMES):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= ASSIGN_VALUE:
                spans.append(Span(m.start(), 0, m.end(), m[2]))
    tokens = list(TOKEN.finditer(text))
    for token in tokens:
        at = token.start()
        for order, pattern, least in ((1, ACCESS, ACCESS_LENGTH), (2, HEX, HEX_LENGTH)):
            for m in pattern.finditer(token[0]):
                if len(m[0]) >= least:
                    spans.append(Span(at + m.start(), order, at + m.end(), m[0]))
    return sorted(spans), tokens


def candidates(spans: list[Span], tokens: list[re.Match]) -> list[re.Match]:
    """Tokens with a digit and a letter that no rule span overlaps."""
    out, at, reach = [], 0, -1
    for token in tokens:  # both lists go from left to right
        while at < len(spans) and spans[at].start < token.end():
            reach = max(reach, spans[at].end)
            at += 1
        if reach <= token.start() and DIGIT.search(token[0]) and LETTER.search(token[0]):
            out.append(token)
    return out


class Automaton:
    """A deterministic automaton with counts; state 0 is the start."""

    def __init__(self, values: list[str] = ()):
        self.visits: list[int] = [0]
        self.stops: list[int] = [0]
        self.next: list[dict[str, list[int]]] = [{}]  # symbol -> [state, count]
        for value in values:
            self._add(value)

    def _add(self, value: str) -> None:
        state = 0
        self.visits[0] += 1
        for symbol in value:
            step = self.next[state].get(symbol)
            if step is None:
                self.visits.append(0)
                self.stops.append(0)
                self.next.append({})
                step = self.next[state][symbol] = [len(self.visits) - 1, 0]
            step[1] += 1
            state = step[0]
            self.visits[state] += 1
        self.stops[state] += 1

    def _alike(self, a: int, b: int, alpha: float) -> bool:
        """No frequency below a and b differs more than the Hoeffding bound allows."""
        width = math.sqrt(0.5 * math.log(2 / alpha))
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.visits[a], self.visits[b]
            bound = width * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.stops[a] / n - self.stops[b] / m) > bound:
                return False
            for symbol in self.next[a].keys() | self.next[b].keys():
                x, y = self.next[a].get(symbol), self.next[b].get(symbol)
                if abs((x[1] if x else 0) / n - (y[1] if y else 0) / m) > bound:
                    return False
                if x and y:
                    todo.append((x[0], y[0]))
        return True

    def _fold(self, into: int, tree: int) -> None:
        todo = [(into, tree)]
        while todo:
            into, tree = todo.pop()
            self.visits[into] += self.visits[tree]
            self.stops[into] += self.stops[tree]
            for symbol, (child, count) in self.next[tree].items():
                step = self.next[into].get(symbol)
                if step is None:
                    self.next[into][symbol] = [child, count]
                else:
                    step[1] += count
                    todo.append((step[0], child))

    def generalise(self, alpha: float = ALPHA) -> Automaton:
        """Merge alike states: settled states stay, each next tree joins one or is settled."""
        settled, front = [0], [(0, s) for s in sorted(self.next[0])]
        while front:
            parent, symbol = front.pop(0)
            state = self.next[parent][symbol][0]
            if state in settled:
                continue
            match = next((s for s in settled if self._alike(s, state, alpha)), None)
            if match is None:
                settled.append(state)
                front += [(state, s) for s in sorted(self.next[state])]
                continue
            self.next[parent][symbol][0] = match
            self._fold(match, state)
            # the fold may have given settled states new branches
            front = [(s, x) for s in settled for x in sorted(self.next[s]) if self.next[s][x][0] not in settled]
        return self.compact()

    def compact(self) -> Automaton:
        """Only the states that can be reached, for sending to the executors."""
        out, names, todo = Automaton(), {0: 0}, [0]
        while todo:
            state = todo.pop()
            at = names[state]
            out.visits[at], out.stops[at] = self.visits[state], self.stops[state]
            for symbol, (child, count) in self.next[state].items():
                if child not in names:
                    names[child] = len(out.visits)
                    out.visits.append(0)
                    out.stops.append(0)
                    out.next.append({})
                    todo.append(child)
                out.next[at][symbol] = [names[child], count]
        return out

    def mean_log_likelihood(self, value: str) -> float:
        """Per character; a character that no value had here leaves the state as it is."""
        state, total = 0, 0.0
        for symbol in value:
            step = self.next[state].get(symbol)
            whole = self.visits[state] + SMOOTH * SYMBOLS
            total += math.log(((step[1] if step else 0) + SMOOTH) / whole)
            state = step[0] if step else state
        total += math.log((self.stops[state] + SMOOTH) / (self.visits[state] + SMOOTH * SYMBOLS))
        return total / (len(value) + 1)


class Formats(NamedTuple):
    kinds: dict[str, Automaton]
    ordinary: Automaton

    def likelihood(self, value: str) -> float:
        """How much likelier the best credential format is than ordinary tokens, per character."""
        if not self.kinds:
            return -math.inf
        return max(a.mean_log_likelihood(value) for a in self.kinds.values()) - self.ordinary.mean_log_likelihood(value)


def _lowest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The values with the lowest hashes of each kind that a task sees."""
    heaps: dict[str, list[tuple[int, str]]] = {}
    for batch in batches:
        for text in batch["text"]:
            spans, tokens = rule_spans(text)
            found = [(KINDS[s.order], s.value) for s in spans]
            found += [(OTHER, t[0]) for t in candidates(spans, tokens)]
            for kind, value in found:
                if len(value) > LONGEST:
                    continue
                heap = heaps.setdefault(kind, [])
                entry = (-(xxhash.xxh64_intdigest(value.encode()) >> 1), value)
                if len(heap) < SAMPLE:
                    if entry not in heap:
                        heapq.heappush(heap, entry)
                elif entry > heap[0] and entry not in heap:
                    heapq.heapreplace(heap, entry)
    for kind, heap in heaps.items():
        yield pd.DataFrame({"kind": kind, "hash": [-h for h, _ in heap], "value": [v for _, v in heap]})


def learn(docs: DataFrame, text_column: str = "text") -> Formats:
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(text_column).alias("text")).where("text <> ''")
    values = texts.mapInPandas(_lowest, "kind string, hash long, value string").distinct()
    ranked = values.groupBy("kind").agg(
        F.slice(F.sort_array(F.collect_set(F.struct("hash", "value"))), 1, SAMPLE).alias("sample")
    )
    samples = {r["kind"]: [x["value"] for x in r["sample"]] for r in ranked.collect()}
    ordinary = Automaton(samples.pop(OTHER, [])).generalise()
    return Formats({k: Automaton(v).generalise() for k, v in sorted(samples.items())}, ordinary)


def all_spans(text: str | None, formats: Formats) -> list[Span]:
    if not text:
        return []
    spans, tokens = rule_spans(text)
    for token in candidates(spans, tokens):
        if formats.likelihood(token[0]) >= MARGIN:
            spans.append(Span(token.start(), KINDS.index("format"), token.end(), token[0]))
    return sorted(spans)


SPANS = "array<struct<kind:string,start:int,end:int>>"


def finder(df: DataFrame, formats: Formats):
    """A column function: text -> array of structs (kind, start, end), in code points."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(formats)

    @F.pandas_udf(SPANS)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(
                [
                    [{"kind": KINDS[s.order], "start": s.start, "end": s.end} for s in all_spans(t, shared.value)]
                    for t in texts
                ],
                dtype=object,
            )

    return find


def secret_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, spans."""
    find = finder(docs, learn(docs, text_column))
    return docs.select(F.col(id_column).alias("doc_id"), find(F.col(text_column)).alias("spans"))


MASK = "[secret]"


def masked(text: str | None, formats: Formats) -> str | None:
    """The text with every span replaced; overlapping spans become one mask."""
    if text is None:
        return None
    out, at = [], 0
    for span in all_spans(text, formats):
        if span.start >= at:
            out += [text[at : span.start], MASK]
        at = max(at, span.end)
    return "".join([*out, text[at:]])


def without_secrets(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """All rows and columns, with secrets masked; n_chars is counted anew where something was."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, text_column))

    @F.pandas_udf("string")
    def mask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([masked(t, shared.value) for t in texts], dtype=object)

    found, before = fresh(docs, "masked"), F.col(text_column)
    out = docs.withColumn(found, mask(before))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        counted = F.char_length(found).cast(kind)
        out = out.withColumn("n_chars", F.when(F.col(found).eqNullSafe(before), F.col("n_chars")).otherwise(counted))
    return out.withColumn(text_column, F.col(found)).select(*docs.columns)
