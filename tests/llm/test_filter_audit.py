import random
import re
from itertools import permutations

from fairwake.llm.catalog import QUERIES, STATEMENTS
from fairwake.llm.filter_audit import COLUMNS, FILTERS, interactions, steps, survivors

FOLDER = "/root/testdata/sf0.001"


def failures(rows):
    """(part, failed letters, doc_id) of (doc_id, text, lang), one document at a time."""
    out = []
    for doc_id, text, lang in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = ""
        failed += "A" * (len(words) < 200)
        failed += "B" * (100 * len(set(words)) < 50 * len(words))
        failed += "C" * (100 * len(re.findall("[A-Z]", text)) > 3 * len(text))
        failed += "D" * bool(re.search("[#$%&*|]", text))
        smaller = (i for i, t, _ in rows if i is not None and doc_id is not None and i < doc_id and (t or "") == text)
        failed += "E" * (next(smaller, None) is not None)
        out.append((lang or "", failed, doc_id))
    return out


def expected(rows, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    docs, out = failures(rows), {}
    for part in {p for p, *_ in docs}:
        mine = [(set(f), i) for p, f, i in docs if p == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [(f, i) for f, i in left if letter in f]
                left = [(f, i) for f, i in left if letter not in f]
                total[letter] += len(gone)
                out[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    sum(letter in f for f, _ in mine) - len(gone),
                    sum(f == {letter} for f, _ in mine),
                    sum(i in good for _, i in gone),
                    sum(i in toxic for _, i in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def found(df):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in COLUMNS) for r in df.collect()}


def test_documents(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert found(QUERIES["op13_filter_audit"](spark, FOLDER)) == expected(rows, labels)


def test_like_duckdb(spark, duck):
    duck.execute(f"CREATE OR REPLACE VIEW labels AS SELECT * FROM read_parquet('{FOLDER}/labels.parquet')")
    out = duck.execute(STATEMENTS["op13_filter_audit"]).df()
    names = ["part", "filter_order", "step", *COLUMNS]
    got = sorted(tuple(r) for r in QUERIES["op13_filter_audit"](spark, FOLDER).select(*names).collect())
    assert got == sorted(tuple(r) for r in out[names].itertuples(index=False))


def test_hard_rows(spark, hard, clashing, nothing):
    columns = "doc_id bigint, quality int, toxic int"
    listed = [(1, 1, 0), (1, 0, 1), (2, None, None), (4, 1, 1), (4, 1, 0), (None, 1, 1), (6, 0, 1), (9, 1, None)]
    labels = spark.createDataFrame(listed, columns)
    rows = [tuple(r) for r in hard.select("doc_id", "text", "lang").collect()]
    want = expected(rows, [label for label in listed if label[0] is not None])
    assert found(interactions(hard, labels)) == want
    names = ("part", "mask", "digest", "n", "of", "first", "good", "toxic", "labelled", "quality")
    wide = clashing.withColumns({c: hard["doc_id"] for c in names})
    assert found(interactions(wide, labels.withColumns({c: labels["doc_id"] for c in ("n", "text", "part")}))) == want
    assert interactions(nothing, labels).count() == 0
    assert found(interactions(hard, labels.where("false"))) == expected(rows, [])


def test_walk_against_every_subset():
    rng = random.Random(1)
    for _ in range(30):
        counts = {m: tuple(rng.randint(0, 9) for _ in range(3)) for m in rng.sample(range(32), rng.randint(0, 32))}
        for subset, state in enumerate(survivors(counts)):
            assert state == tuple(sum(c[i] for m, c in counts.items() if not m & subset) for i in range(3))


def test_steps_add_up():
    counts = {0: (5, 1, 0), 1: (2, 0, 1), 3: (4, 2, 2), 31: (1, 0, 0), 16: (3, 1, 1)}
    rows = steps(counts)
    assert len(rows) == 600 and {r[0] for r in rows} == {"".join(o) for o in permutations(FILTERS)}
    for order in {r[0] for r in rows}:
        removed = [r[3] for r in rows if r[0] == order]
        assert sum(removed) == 10 and [r[2] for r in rows if r[0] == order][-1] == 5
    by_filter = {r[0][r[1] - 1]: r[8] for r in rows}
    assert sum(by_filter.values()) == 120 * 10


def test_a_text_of_a_third_of_all_rows_is_spread(spark):
    """Copies meet the first of them by digest and id, so they do not share a key."""
    rows = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'same', concat('x', id)) AS text", "'en' AS lang")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    out = found(interactions(rows, labels))
    assert out["en", "EABCD", 1][:2] == (2001, 999)
