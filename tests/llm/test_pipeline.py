import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from fairwake.llm.common import tokenizer_path
from fairwake.llm.langid import MIN_SCORE, held_out, scores, train
from fairwake.llm.secrets import learn, masked
from fairwake.llm.simhash import fingerprint

FOLDER = "/root/testdata/sf0.001"
OF_DOCUMENTS = corpus_pipeline.STAGES[:-1]


def speakable(rows, model):
    """Documents with a letter whose best language is likelier than not."""
    texts = [r["text"] or "" for r in rows]
    found = scores(texts, model)
    return [
        r
        for r, row, text in zip(rows, np.asarray(found), texts)
        if any(c.isalpha() for c in text) and (np.exp(row - row.max()) / np.exp(row - row.max()).sum()).max() >= MIN_SCORE
    ]


def one_of_equal(rows):
    groups = {}
    for r in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "")
        groups.setdefault(body, []).append(r)
    return [min(g, key=lambda r: (-len(r["text"] or ""), r["doc_id"])) for g in groups.values()]


def one_of_near(rows):
    """Groups of documents within three bits of each other, by trying all pairs."""
    points = np.array([fingerprint(r["text"] or "") for r in rows], dtype=np.int64).view(np.uint64)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(points[i + 1 :] ^ points[i]) <= 3):
            a, b = sorted((find(i), find(i + 1 + int(j))))
            root[b] = a
    best = {}
    for i, r in enumerate(rows):
        best[find(i)] = min(best.get(find(i), r), r, key=lambda x: x["doc_id"])
    return list(best.values())


def test_every_stage_against_plain_python(spark, docs):
    rows = [r.asDict() for r in docs.collect()]
    frame, plain = docs, rows
    for name, stage in OF_DOCUMENTS:
        out = stage(spark, frame, FOLDER)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        if name == "language":
            model = train(frame.where(~held_out("doc_id")), "doc_id", "text", "lang")
            plain = speakable(plain, model)
        elif name == "exact_copies":
            plain = one_of_equal(plain)
        elif name == "near_copies":
            plain = one_of_near(plain)
        else:
            formats = learn(frame)
            clean = [r | {"text": masked(r["text"], formats)} for r in plain]
            plain = [c if c["text"] == r["text"] else c | {"n_chars": len(c["text"])} for c, r in zip(clean, plain)]
        frame = spark.createDataFrame(out.collect(), docs.schema)
        key = lambda r: r["doc_id"]
        assert sorted((r.asDict() for r in frame.collect()), key=key) == sorted(plain, key=key), name
    assert 0 < len(plain) < len(rows)

    reference, pieces = Tokenizer.from_file(tokenizer_path()), {}
    for r in corpus_pipeline.run(spark, FOLDER).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
    assert pieces.keys() == {r["doc_id"] for r in plain}
    for r in plain:
        ids = np.array([*reference.encode(r["text"], add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for p in sorted(pieces[r["doc_id"]], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_hard_rows(spark, hard, clashing, nothing, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    for table in (hard, clashing, nothing):
        out = stage(spark, table, FOLDER)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == table.columns
        assert (out.count() == 0) == (table is nothing)


def test_null_and_blank_texts_go_with_the_language(spark, hard):
    left = corpus_pipeline.language(spark, hard, FOLDER).select("text").collect()
    assert left and all(any(c.isalpha() for c in r["text"]) for r in left)

