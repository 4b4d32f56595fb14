import hashlib
import re

from pyspark.sql import functions as F

from fairwake.llm.catalog import QUERIES, STATEMENTS
from fairwake.llm.common import written
from fairwake.llm.exact_dedup import exact_groups, repeated_slots, without_copies

FOLDER = "/root/testdata/sf0.001"


def expected(rows):
    """(doc_id, text) -> sorted rows, by the plain definition."""
    groups = {}
    for at, (doc_id, text) in enumerate(rows):
        body = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(body, []).append((-len(text or ""), doc_id is None, doc_id or 0, at, doc_id))
    out = []
    for body, members in groups.items():
        keep = min(members)
        for m in members:
            digest = hashlib.sha256(body.encode()).hexdigest()
            out.append((m[4], keep[4], len(members), m[:3] == keep[:3], digest))
    return out


def test_hard_rows(hard, clashing):
    rows = [(r["doc_id"], r["text"]) for r in hard.select("doc_id", "text").collect()]
    want = expected(rows)
    for table in (hard, clashing):
        got = [tuple(r) for r in exact_groups(table, hash_all=True).collect()]
        assert sorted(map(str, ((a, b, c, e) for a, b, c, _, e in got))) == sorted(
            map(str, ((a, b, c, e) for a, b, c, _, e in want))
        )
        # one row of each group stays, although two rows have the same id and text
        kept = [r for r in got if r[3]]
        assert len(kept) == len({r[4] for r in kept}) == len({r[4] for r in want})


def test_unique_texts_are_not_hashed(spark):
    rows = spark.createDataFrame([(i, f"text number {i}") for i in range(50)] + [(99, "text  number 7")], "doc_id int, text string")
    got = {r["doc_id"]: r for r in exact_groups(rows).collect()}
    assert got[7]["full_hash"] and got[7]["full_hash"] == got[99]["full_hash"]
    assert sum(r["full_hash"] is not None for r in got.values()) < 10
    assert got[99]["kept"] and not got[7]["kept"] and got[7]["keep_id"] == 99
    # slots that all collide change nothing but the number of hashed texts
    assert {tuple(r)[:4] for r in exact_groups(rows, slots=1).collect()} == {tuple(r)[:4] for r in got.values()}


def test_more_repeated_texts_than_slots(spark):
    """Every slot is marked, so all texts are hashed; groups and what stays are the same."""
    rows = [(i, f"text number {i % 400} of many") for i in range(1000)] + [(5000 + i, f"single {i}") for i in range(50)]
    table = spark.createDataFrame(rows, "doc_id int, text string")
    few, enough = exact_groups(table, slots=64).collect(), exact_groups(table).collect()
    assert {tuple(r)[:4] for r in few} == {tuple(r)[:4] for r in enough}
    assert all(r["full_hash"] for r in few) and sum(r["full_hash"] is None for r in enough) > 30
    again = repeated_slots(table)
    assert again.number >= 16 * 400 and again.number & (again.number - 1) == 0
    assert again.table.agg(F.sum(F.bit_count("bits"))).first()[0] <= 400 and again.table.count() <= again.number // 64
    assert sorted(r["doc_id"] for r in without_copies(table).collect()) == [*range(400), *range(5000, 5050)]


def test_a_hot_text_is_split(spark):
    """A third of all rows share a text; their join is dealt to several tasks."""
    low = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "256k",
        "spark.sql.files.openCostInBytes": "1k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in low}
    texts = F.expr("if(id % 3 = 0, repeat('hot text ', 40), concat(repeat('some text ', 40), id div 2))")
    try:
        for name, value in low.items():
            spark.conf.set(name, value)
        rows = written(spark.range(0, 60_000, 1, 8).select(F.col("id").alias("doc_id"), texts.alias("text")), "test-hot")
        groups, kept = exact_groups(rows), without_copies(rows)
        assert len(groups.collect()) == 60_000
        assert len({r["doc_id"] for r in kept.collect()}) == len({r["full_hash"] or r["doc_id"] for r in groups.collect()})
        for df in (groups, kept):
            assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_long_common_prefix(spark):
    rows = [(1, "a" * 5000 + "b"), (2, "a" * 5000 + "c"), (3, "a" * 5000 + " c")]
    got = {r["doc_id"]: r["keep_id"] for r in exact_groups(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert got == {1: 1, 2: 3, 3: 3}


def test_empty_table(nothing):
    assert exact_groups(nothing).count() == 0
    assert without_copies(nothing).columns == nothing.columns and without_copies(nothing).count() == 0


def test_rows_that_stay(hard, clashing):
    for table in (hard, clashing):
        kept = without_copies(table)
        assert kept.columns == table.columns
        ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
        # blank texts: 3 is the longest; "Éa b": 5 is; the long text with a space more is 7
        assert sorted(ids) == [3, 5, 7, 8, 9]


def test_repeated_row_stays_once(spark):
    rows = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "c"), (3, "ab")], "doc_id int, text string")
    assert sorted(map(tuple, without_copies(rows).collect())) == [(1, "a b"), (2, "c")]


def test_same_as_sql(spark, duck):
    got = QUERIES["op10_exact_dedup"](spark, FOLDER)
    found = duck.execute(STATEMENTS["op10_exact_dedup"])
    names = [d[0] for d in found.description]
    assert sorted(map(str, map(tuple, got.select(*names).collect()))) == sorted(map(str, found.fetchall()))


def test_of_a_repeated_id_the_longest_row_stays(spark):
    rows = [(4, "a b", "x"), (4, "a  b", "y"), (4, "ab", "z"), (6, "c", "x"), (None, "d", None), (None, "d", None)]
    kept = without_copies(spark.createDataFrame(rows, "doc_id int, text string, source string"))
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(4, "a  b", "y"), (6, "c", "x"), (None, "d", None)], key=str)
