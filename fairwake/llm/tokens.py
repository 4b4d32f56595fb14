"""Token ids of whole Arrow batches of texts, as the `tokenizers` library gives them.

A space between two characters that aren't white space always starts a new word of a plain
byte-level tokenizer, so what lies between such spaces has ids of its own. A batch is cut
there, each distinct word is encoded once, and the ids of the texts are gathered from the
words' with numpy. Strings of special tokens in a text become that token, and what lies
between them is encoded by itself, as the library does.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from tokenizers import Tokenizer

# Texts are encoded so many bytes at a time; a longer text makes a batch of its own.
BATCH_BYTES = 8 << 20

# Fixed value: how byte-level BPE files of this family split a text into words.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Fixed value: white space, with the separators 1C to 1F that some libraries count too.
SPACE = r"[\x09-\x0D\x1C-\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
# A space that may not be a cut: next to white space, or last in the text.
NO_CUT = rf" {SPACE}|{SPACE} | \z"


def _letters_of_bytes() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_ranks(content: dict) -> dict[bytes, int] | None:
    """The vocabulary by bytes if the file is plain byte-level BPE whose ids follow its merges."""
    model, pre = content["model"], content["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
    if not plain or pre.get("add_prefix_space") or content["normalizer"] or model.get("ignore_merges"):
        return None
    added = content["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
        return None
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [model["vocab"].get(a + b, -1) for a, b in merges]
    if ids != sorted(ids) or -1 in ids:
        return None
    special = {t["content"] for t in added}
    letters = _letters_of_bytes()
    return {bytes(letters[c] for c in w): i for w, i in model["vocab"].items() if w not in special}


class Encoder:
    """Ids of texts, and where each text's ids start.

    Words go to `tiktoken` with the file's own vocabulary where that is sure to give the
    same ids as `tokenizers`, at a fraction of the cost; else texts go to `tokenizers`.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        ranks = byte_ranks(content)
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.fast = ranks and tiktoken.Encoding(
            path, pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens=self.special
        )
        if self.fast:
            self.widths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
            for word, number in ranks.items():
                self.widths[number] = len(word)

    def encode(self, texts: pa.StringArray, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids as unsigned 32-bit numbers, offsets): text i has ids[offsets[i]:offsets[i + 1]].

        With `end`, that id follows each text and counts as its own.
        """
        tail = [] if end is None else [end]
        if not self.fast:
            encoded = self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)
            lists = [np.array([*e.ids, *tail], dtype=np.uint32) for e in encoded]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)])
            return np.concatenate(lists or [np.empty(0, np.uint32)]), offsets.astype(np.int64)

        whole = pc.match_substring_regex(texts, NO_CUT)
        for mark in self.special:
            whole = pc.or_(whole, pc.match_substring(texts, mark))
        split = pc.split_pattern(pc.if_else(whole, "", texts), " ")
        starts = np.asarray(split.offsets) - split.offsets[0].as_py()
        words = split.flatten().dictionary_encode()
        pool, ends = self._words(words.dictionary)

        # a text's first word, or all of a text that is not cut, has a unit of its own
        firsts = split.flatten().take(pa.array(starts[:-1])).to_pylist()
        for i in np.flatnonzero(whole.to_numpy(zero_copy_only=False)):
            firsts[i] = texts[int(i)].as_py()
        own = [self.fast.encode(t, allowed_special="all") for t in firsts]
        lengths = np.concatenate([np.diff(ends, prepend=0), [len(ids) for ids in own], [len(tail)]]).astype(np.int64)
        pool = np.concatenate([pool, *(np.array(ids, np.uint32) for ids in own), np.array(tail, np.uint32)])
        unit_starts = np.cumsum(lengths) - lengths

        units = words.indices.to_numpy().astype(np.int64)
        units[starts[:-1]] = len(ends) + np.arange(len(firsts))
        units = np.insert(units, starts[1:], len(lengths) - 1)  # the end mark
        taken = lengths[units]
        at = np.cumsum(taken) - taken
        ids = pool[np.repeat(unit_starts[units] - at, taken) + np.arange(taken.sum())]
        last = starts[1:] + np.arange(len(firsts))  # where the end marks are among the units
        offsets = np.concatenate([[0], (at + taken)[last]]).astype(np.int64)
        return ids, offsets

    def _words(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, each with a space before it, and where each word's ids end."""
        if not len(words):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        # an empty word is only ever the first of a text, whose unit is not taken from here
        spaced = pc.binary_join_element_wise("", pc.if_else(pc.equal(words, ""), "x", words), " ")
        _, places, data = spaced.buffers()
        ends = np.frombuffer(places, np.int32)[spaced.offset : spaced.offset + len(spaced) + 1].astype(np.int64)
        joined = data[int(ends[0]) : int(ends[-1])].to_pybytes().decode()
        ids = self.fast.encode_to_numpy(joined, disallowed_special=()).astype(np.uint32)
        return ids, np.searchsorted(np.cumsum(self.widths[ids]), ends[1:] - ends[0]) + 1


_encoders: dict[str, Encoder] = {}  # of this Python worker


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `limit` bytes of text, however they arrive."""
    held, size = [], 0

    def joined() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = 0
        for i, n in enumerate(lengths.tolist()):
            size += n
            if size >= limit:
                held.append(batch.slice(start, i + 1 - start))
                yield joined()
                held, size, start = [], 0, i + 1
        if start < len(lengths):
            held.append(batch.slice(start))
    if held:
        yield joined()
