import re

from fairwake.llm.catalog import QUERIES, STATEMENTS
from fairwake.llm.quality import RULES, Rule, quality

FOLDER = "/root/testdata/sf0.001"


def measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    places = {i + j for i, g in enumerate(grams) if seen[g] > 1 for j in range(3)}
    lines = [s for s in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(places),
    )


def test_measures(hard, clashing, docs):
    for table in (hard, clashing, docs):
        judged = quality(table)
        for row in judged.select("text", judged.columns[-1]).collect():
            q = row[1]
            got = (q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"], q["n_repeat_words"])
            assert got == measures(row["text"])
            assert q["base_failed"] == (got[0] < 50 or 100 * got[4] > 50 * got[0])
            assert not (q["kept"] and q["base_failed"])


def test_repeats_that_overlap(spark):
    texts = ["a a a a", "a b c x a b c", "a b a b a b", "a b c", "a b", "x\n \nx\ny\n", "# a\n# a"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r["text"]: r["quality"] for r in quality(rows).select("text", "quality").collect()}
    for text in texts:
        assert (got[text]["n_words"], got[text]["n_dup_lines"], got[text]["n_repeat_words"]) == (
            measures(text)[0],
            measures(text)[3],
            measures(text)[4],
        )


def test_rules_are_a_table(spark):
    rows = spark.createDataFrame([("word " * 60,), ("one two three " + " ".join(map(str, range(60))),)], "text string")
    none = quality(rows, rules=()).select("quality.failed").collect()
    assert [r["failed"] for r in none] == [[], []]
    own = (Rule("digits", "letter_word_ratio", "<", 0.5),)
    assert [r["failed"] for r in quality(rows, rules=own).select("quality.failed").collect()] == [[], ["digits"]]
    assert len({r.name for r in RULES}) == len(RULES)


def test_other_columns_stay(clashing, nothing):
    assert quality(clashing).columns == [*clashing.columns, "quality_"]
    assert quality(nothing).count() == 0


def test_no_python_in_the_plan(docs):
    plan = quality(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_clean_documents_are_kept(spark, docs):
    """Documents labelled good fail only the base rule."""
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1")
    judged = quality(docs).join(labels.select("doc_id"), "doc_id").select("quality.*")
    assert judged.count() > 20
    assert judged.where("NOT base_failed AND NOT kept").count() == 0


def test_a_filter_on_the_result_does_not_repeat_the_work(docs):
    plan = quality(docs).where("NOT quality.kept")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate")  # the filter stays above it


def test_same_as_sql(spark, duck):
    got = QUERIES["op6_quality_rules"](spark, FOLDER)
    found = duck.execute(STATEMENTS["op6_quality_rules"])
    names = [d[0] for d in found.description]
    assert sorted(map(str, map(tuple, got.select(*names).collect()))) == sorted(map(str, found.fetchall()))
