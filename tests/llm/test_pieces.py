import struct

import pytest
import sentencepiece

from fairwake.llm.common import tokenizer_path
from fairwake.llm.pieces import decode, encode

PATH = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def joined(rows, field, empty):
    """Chunks of each document, put together in order."""
    out = {}
    for r in sorted(rows, key=lambda r: (r["row"], r["chunk"])):
        out.setdefault(r["row"], (r["doc_id"], []))[1].append(r[field])
    return sorted(((i, empty.join(parts)) for i, parts in out.values()), key=str)


def test_chunks_give_the_ids_of_the_whole_text(hard, library):
    rows = [(r["doc_id"], r["text"] or "") for r in hard.select("doc_id", "text").collect()]
    want = sorted(((i, struct.pack(f"<{len(e)}I", *e)) for i, e in ((i, library.encode(t)) for i, t in rows)), key=str)
    for giant, chunk in ((1 << 16, 1 << 14), (10, 64)):
        got = encode(hard, PATH, giant=giant, chunk=chunk).collect()
        assert any(r["chunks"] > 1 for r in got)
        assert joined(got, "ids", b"") == want


def test_decoding_gives_the_text_back(hard):
    rows = [(r["doc_id"], r["text"] or "") for r in hard.select("doc_id", "text").collect()]
    got = decode(encode(hard, PATH, giant=100, chunk=64), PATH).collect()
    assert joined(got, "text", "") == sorted(rows, key=str)


def test_whole_table(docs, texts, library):
    got = encode(docs, PATH, giant=300, chunk=128).collect()
    want = sorted(((i, struct.pack(f"<{len(e)}I", *e)) for i, e in ((i, library.encode(t or "")) for i, t in texts.items())), key=str)
    assert joined(got, "ids", b"") == want


def test_clashing_columns_and_empty_table(clashing, nothing):
    assert encode(clashing, PATH).where("chunk = 0").count() == clashing.count()
    assert decode(encode(nothing, PATH), PATH).count() == 0
