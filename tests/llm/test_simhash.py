import random

import numpy as np
import pytest
import xxhash

from fairwake.llm.components import roots
from fairwake.llm.simhash import choices, fingerprint, near_groups, near_links, one_of_each


def plain_fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text)
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", words)]
    grams = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return bits - (1 << 64) if bits >> 63 else bits


def grouped(rows):
    """[(doc_id, fingerprint)] -> smallest id reachable in steps of up to 3 bits."""
    points = np.array([f for _, f in rows], dtype=np.int64).view(np.uint64)
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= 3
    label = list(range(len(rows)))
    while True:
        new = [min(label[j] for j in np.flatnonzero(near[i])) for i in range(len(rows))]
        if new == label:
            break
        label = new
    best = {}
    for (doc_id, _), k in zip(rows, label):
        best[k] = min((x for x in (best.get(k), doc_id) if x is not None), default=None)
    return [best[k] for k in label]


def test_fingerprints(hard, clashing, docs):
    for table in (hard, clashing, docs):
        got = near_groups(table).collect()
        texts = {}
        for r in table.select("doc_id", "text").collect():
            texts.setdefault(r["doc_id"], set()).add(plain_fingerprint(r["text"] or ""))
        assert len(got) == table.count()
        assert all(r["fingerprint"] in texts[r["doc_id"]] for r in got)
        rows = [(r["doc_id"], r["fingerprint"]) for r in got]
        assert [r["component_id"] for r in got] == grouped(rows)


def test_windows_of_long_texts(monkeypatch):
    text = " ".join(str(i * i) for i in range(2000))
    whole = fingerprint(text)
    monkeypatch.setattr("fairwake.llm.simhash.WINDOWS", 7)
    assert fingerprint(text) == whole == plain_fingerprint(text)


def test_every_close_pair_agrees_under_a_choice():
    masks = choices()
    assert len(masks) == 20
    rng = random.Random(3)
    for _ in range(500):
        flips = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(flips & m == 0 for m in masks)


@pytest.mark.parametrize("hot", [4096, 16, 2])
def test_links_join_what_brute_force_joins(spark, hot):
    """A chain, a ball around one point, and strangers; also when every key is too crowded."""
    rng = random.Random(hot)
    points, at = set(), 0
    for _ in range(60):
        at ^= sum(1 << b for b in rng.sample(range(64), 3))
        points.add(at)
    centre = rng.getrandbits(64)
    points |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(150)}
    points |= {rng.getrandbits(64) for _ in range(200)}
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in points)
    links = near_links(spark.createDataFrame([(p,) for p in signed], "point long"), hot=hot)
    for r in links.collect():
        assert ((r["a"] ^ r["b"]) & ((1 << 64) - 1)).bit_count() <= 3
    root = {r["node"]: r["root"] for r in roots(links).collect()}
    assert [root.get(p, p) for p in signed] == grouped([(p, p) for p in signed])


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(5, 5), (7, 6)]
    rng = random.Random(1)
    rng.shuffle(links)
    got = dict(map(tuple, roots(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(1, 51)}, **{100 + i: 100 for i in range(1, 40)}}
    assert roots(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each(hard, clashing, nothing):
    for table in (hard, clashing):
        kept = one_of_each(table)
        assert kept.columns == table.columns
        ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
        assert {6, 8, 9, 1} <= set(ids) and 7 not in ids and 3 not in ids and 5 not in ids
        assert ids.count(None) == 2
    assert one_of_each(nothing).count() == 0
