import zlib
from collections import Counter

from fairwake.llm.catalog import QUERIES
from fairwake.llm.sharding import RING, capacities, shard_rows, virtual_nodes, walk

FOLDER = "/root/testdata/sf0.001"


def one_by_one(counts, owners, limits):
    """Place every key alone: first those that fit at home, then the others clockwise."""
    free, placed = list(limits), {}
    for arc, rows in enumerate(counts):
        for rank in range(rows):
            if free[owners[arc]]:
                free[owners[arc]] -= 1
                placed[arc, rank] = owners[arc]
    for arc, rows in enumerate(counts):
        for rank in range(rows):
            node = arc
            while (arc, rank) not in placed:
                node = (node + 1) % len(owners)
                if free[owners[node]]:
                    free[owners[node]] -= 1
                    placed[arc, rank] = owners[node]
    return placed


def test_walk_on_counts_is_the_walk_of_keys():
    for seed in range(30):
        owners = [(i * 7 + seed) % 4 for i in range(12)]
        counts = [(i * i * 3 + seed * 5) % 17 * (i % 3) for i in range(12)]
        limits = capacities(sum(counts), 4)
        spans = walk(counts, owners, limits)
        got = {(s.arc, r): s.shard for s in spans for r in range(s.first, s.end)}
        assert got == one_by_one(counts, owners, limits)
        for shard in range(4):
            slots = sorted(s.slot + r - s.first for s in spans if s.shard == shard for r in range(s.first, s.end))
            assert slots == list(range(limits[shard]))


def test_nodes_stay_when_a_shard_is_added():
    before, after = dict(virtual_nodes(8)), dict(virtual_nodes(9))
    assert all(after[slot] == shard for slot, shard in before.items() if after[slot] != 8)
    assert sum(shard == 8 for shard in after.values()) == 64 and max(after) < RING


def test_counts_are_at_most_one_apart(hard, clashing, docs):
    for table in (hard, clashing, docs):
        rows = shard_rows(table, 5).collect()
        assert len(rows) == table.count()
        sizes = Counter(r["shard"] for r in rows)
        assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(5)) <= 1
        for shard, n in sizes.items():
            assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))


def test_one_id_may_hold_all_rows(spark):
    rows = spark.range(1000).selectExpr("7 AS doc_id", "CAST(id AS string) AS text")
    sizes = Counter(r["shard"] for r in shard_rows(rows, 8).collect())
    assert set(sizes.values()) == {125}


def test_slack_keeps_more_rows_at_home(docs):
    tight, loose = (shard_rows(docs, 8, slack=s).where("shard <> home_shard").count() for s in (0.0, 0.25))
    rows, most = docs.count(), max(Counter(r["shard"] for r in shard_rows(docs, 8, slack=0.25).collect()).values())
    assert loose <= tight < rows / 3 and most <= 1.25 * rows / 8 + 1


def test_few_rows_move_when_a_shard_is_added(docs):
    big = docs.crossJoin(docs.sparkSession.range(20).withColumnRenamed("id", "n")).selectExpr("doc_id * 20 + n AS doc_id", "'' AS text")
    at = lambda n: {r["doc_id"]: r["shard"] for r in shard_rows(big, n).collect()}
    eight, nine = at(8), at(9)
    assert sum(eight[k] != nine[k] for k in eight) < 0.35 * len(eight)


def test_columns(spark, texts):
    rows = QUERIES["op1_shards"](spark, FOLDER).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "rows", None)


def test_empty_table(nothing):
    assert shard_rows(nothing, 8).count() == 0
