import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from fairwake.llm.catalog import QUERIES
from fairwake.llm.common import tokenizer_path
from fairwake.llm.packing import SegmentTree, best_fit_decreasing, pack
from fairwake.llm.tokens import Encoder, by_bytes

FOLDER = "/root/testdata/sf0.001"
ODD = ["a  b", " a", "a ", "a\n\nb c", "a \n b", "\t", "", "  ", "a   ", "don't 's  't x\x1c y\x85 z", "x  y  z  ", "foo  \nbar", "<|endoftext|> x", "x" * 300 + " é　b"]


def one_by_one(lengths, window):
    free = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(free) if room >= n]
        if fits:
            free[min(fits, key=lambda i: free[i])] -= n
        else:
            free.append(window - n)
    return sorted(free)


def test_counts_pack_like_single_pieces():
    rng = random.Random(2)
    for _ in range(150):
        window = rng.choice([4, 16, 100])
        lengths = [rng.randint(1, window) for _ in range(rng.randint(0, 120))]
        counts = [0] * (window + 1)
        for n in lengths:
            counts[n] += 1
        windows, ranks = {}, Counter()
        for s in best_fit_decreasing(counts, window):
            assert s.first == ranks[s.length]
            ranks[s.length] = s.end
            for rank in range(s.first, s.end):
                at = rank - s.first
                windows.setdefault(s.sequence + at // s.each, []).append((s.offset + at % s.each * s.length, s.length))
        free = []
        for pieces in windows.values():
            end = 0
            for offset, n in sorted(pieces):
                assert offset == end
                end += n
            free.append(window - end)
        assert sorted(free) == one_by_one(lengths, window)
        assert sorted(windows) == list(range(len(windows))) and sum(ranks.values()) == len(lengths)


def test_plan_has_a_size_bound():
    rng = random.Random(5)
    assert len(best_fit_decreasing([0] + [rng.randint(0, 10**9) for _ in range(1024)])) < 5000


def test_segment_tree():
    tree, rng, values = SegmentTree(100), random.Random(1), set()
    for _ in range(2000):
        v = rng.randint(0, 100)
        values ^= {v}
        tree.set(v, v in values)
        ask = rng.randint(0, 100)
        assert tree.smallest_from(ask) == min((x for x in values if x >= ask), default=None)


def test_same_ids_as_tokenizers(texts):
    """As an unmodified tokenizer gives them, strings of special tokens included."""
    reference = Tokenizer.from_file(tokenizer_path())
    parts = [" ", " ", "a", "b", "'s", "\n", "\t", "é", "12", ".", "\x1c", "\u3000", "<|endoftext|>", "<|endo", "語"]
    rng = random.Random(1)
    mixed = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(3000)]
    sample = [*ODD, *mixed, *(t for t in list(texts.values())[:120] if t)]
    wanted = [e.ids for e in reference.encode_batch(sample, add_special_tokens=False)]
    assert any(50256 in ids for ids in wanted)
    fast, slow = Encoder(tokenizer_path()), Encoder(tokenizer_path())
    slow.fast = None
    for encoder in (fast, slow):
        for end in (None, 0):
            ids, offsets = encoder.encode(pa.array(sample), end)
            got = [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
            assert got == [[*w, *([] if end is None else [end])] for w in wanted]
        ids, offsets = encoder.encode(pa.array([], pa.string()), 0)
        assert len(ids) == 0 and offsets.tolist() == [0]


def test_batches_by_bytes():
    rows = pa.record_batch({"i": list(range(9)), "text": ["x" * n for n in (1, 2, 30, 0, 4, 4, 4, 1, 1)]})
    parts = list(by_bytes(iter([rows.slice(0, 4), rows.slice(4, 5)]), "text", 10))
    assert [p.column("i").to_pylist() for p in parts] == [[0, 1, 2], [3, 4, 5, 6], [7, 8]]
    assert list(by_bytes(iter([]), "text")) == []


def check(rows, texts, window):
    reference = Tokenizer.from_file(tokenizer_path())
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc_id, text in texts.items():
        ids = [*reference.encode(text or "", add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(by_doc.pop(doc_id), key=lambda r: r["start"]):
            piece = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(piece) and r["doc_tokens"] == len(ids)
            assert "ids" not in r.asDict() or bytes(r["ids"]) == piece
            at += r["length"]
        assert at == len(ids)
    assert not by_doc
    for pieces in by_sequence.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= window
    return len(by_sequence)


def test_documents(spark, texts):
    rows = QUERIES["op8_packing"](spark, FOLDER).collect()
    used = check(rows, texts, 1024)
    assert used == len(one_by_one([r["length"] for r in rows], 1024))


def test_hard_rows(spark, hard, clashing, nothing):
    once = hard.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    special = spark.createDataFrame([(77, "a <|endoftext|> b<|endoftext|>", "en", "c", 9)], once.schema)
    once = once.union(special)
    texts = {r["doc_id"]: r["text"] for r in once.collect()}
    check(pack(once, tokenizer_path(), window=64).collect(), texts, 64)
    for table in (hard, clashing):
        rows = pack(table, tokenizer_path()).collect()
        assert Counter(r["doc_id"] for r in rows if r["start"] == 0) == Counter(r["doc_id"] for r in table.select("doc_id").collect())
    assert pack(nothing, tokenizer_path()).count() == 0
