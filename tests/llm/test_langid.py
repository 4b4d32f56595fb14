import math
import zlib
from collections import Counter

from pyspark.sql import functions as F

from fairwake.llm.catalog import QUERIES
from fairwake.llm.langid import BUCKETS, ORDERS, code_points, columns_of, identify, train, with_known_language

FOLDER = "/root/testdata/sf0.001"


def plain_posteriors(train_rows, texts):
    """Naive Bayes with dictionaries, one n-gram after another."""
    counts, priors = {}, Counter()
    for language, text in train_rows:
        priors[language] += 1
        points = code_points(text)
        for order in ORDERS:
            counts.setdefault(language, Counter()).update(columns_of(points, order).tolist())
    out = []
    for text in texts:
        logs = {}
        for language in priors:
            total = sum(counts[language].values()) + BUCKETS
            logs[language] = math.log(priors[language] / sum(priors.values()))
            for order in ORDERS:
                for bucket in columns_of(code_points(text), order).tolist():
                    logs[language] += math.log((counts[language][bucket] + 1) / total)
        best = min(logs, key=lambda k: (-logs[k], k))
        out.append((best, 1 / sum(math.exp(v - logs[best]) for v in logs.values())))
    return out


def test_same_as_counting_by_hand(docs, texts):
    found = identify(docs)
    rows = found.select("doc_id", "text", "lang", F.col(found.columns[-1]).alias("l")).collect()
    learned = [(r["lang"], r["text"]) for r in rows if r["lang"] and r["text"] and not r["l"]["held_out"]]
    some = [r for r in rows if r["text"] and len(r["text"]) < 700][:25]
    for r, (language, score) in zip(some, plain_posteriors(learned, [r["text"] for r in some])):
        assert r["l"]["lang"] == language and abs(r["l"]["score"] - score) < 1e-6


def test_held_out_accuracy(spark):
    rows = QUERIES["op5_language_id"](spark, "/root/testdata/sf0.01").collect()
    labels = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(labels) and len(held) > 200
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang_pred"] == labels[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_slices_of_long_texts(monkeypatch):
    points = code_points("abcdefghij" * 10)
    whole = {o: columns_of(points, o).tolist() for o in ORDERS}
    monkeypatch.setattr("fairwake.llm.langid.SLICE", 7)
    from fairwake.llm.langid import slices

    assert {o: [c for s in slices(points, o) for c in s.tolist()] for o in ORDERS} == whole


def test_hard_rows(hard, clashing, nothing):
    for table in (hard, clashing):
        found = identify(table)
        assert found.columns[:-1] == table.columns
        got = [(r["text"], r[-1]) for r in found.collect()]
        for text, result in got:
            unknown = not any(map(str.isalpha, text or ""))
            assert (result["lang"] == "und") == unknown and (result["score"] > 0) != unknown
        kept = with_known_language(table)
        assert kept.columns == table.columns
        assert 0 < kept.count() <= sum(r["lang"] != "und" for _, r in got)
    assert identify(nothing).count() == 0 and with_known_language(nothing).count() == 0


def test_nothing_to_learn_from(hard):
    blank = hard.withColumn("lang", F.lit(None).cast("string"))
    assert {r[-1]["lang"] for r in identify(blank).collect()} == {"und"}


def test_the_sample_has_a_bound_per_language(spark):
    rows = spark.range(3000).selectExpr("id", "if(id % 10 = 0, 'xx', 'yy') AS lang", "if(id % 10 = 0, 'ab', 'cd') AS text")
    model = train(rows, "id", "text", "lang", rows=200)
    assert model.languages == ["xx", "yy"]
    assert abs(math.exp(model.log_prior[0]) - 0.1) < 1e-9  # priors from all rows
    yy = columns_of(code_points("cd"), 2)[0]
    share = math.exp(model.log_likelihood[yy, 1])
    assert 100 / (BUCKETS + 1000) < share < 320 / BUCKETS  # about 200 of 2700 rows were counted
