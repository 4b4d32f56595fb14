import math
import random
import re

from fairwake.llm.catalog import QUERIES
from fairwake.llm.licenses import BASE_PHRASES, MIN_SCORE, SHIFT, TEMPLATES, frequencies, index_words, license_labels

FOLDER = "/root/testdata/sf0.001"


def words_of(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def base_places(words):
    out = []
    for phrase in BASE_PHRASES:
        parts = phrase.split()
        out += [(i, phrase) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    return sorted(out)


MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software)"
CASES = {
    1: "Released under the MIT License.",
    2: "mit-license MIT LICENSE mit licenses, the mit  license",
    3: MIT,
    4: MIT.replace("free of charge", "for a fee"),
    5: "Licensed under the Apache License, Version 2.0. GNU General Public License",
    6: "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    7: "redistribution of source forms in binary modification, without conditions permitted",
    8: "",
    9: None,
    10: "the apáche licenſe mité license MITK License KMIT license",
    11: "license " * 3000 + "mit license",
    12: "subject to the terms of the Mozilla Public License, v. 2.0.",
    13: "licensed under a Creative Commons Attribution 4.0 International License",
}


def test_cases(spark):
    filler = [(100 + i, f"some ordinary words number {i} in the text of a document") for i in range(60)]
    rows = spark.createDataFrame([*CASES.items(), *filler], "doc_id int, text string")
    got = {r["doc_id"]: r for r in license_labels(rows).collect()}
    assert len(got) == len(CASES) + 60
    for key, r in got.items():
        words = words_of(CASES.get(key, dict(filler).get(key)))
        assert r["n_words"] == len(words)
        assert [(b["place"], b["phrase"]) for b in r["base"]] == base_places(words)
        assert set(r["base_labels"]) <= set(r["labels"]) and 0 <= r["score"] <= 1
    labels = {k: r["labels"] for k, r in got.items()}
    assert labels[1] == ["mit"] and labels[3] == ["mit"] and got[3]["base_labels"] == []
    assert labels[4] == [] and labels[7] == [] and labels[8] == labels[9] == labels[10] == []
    assert labels[5] == ["apache", "gpl"] and labels[6] == ["bsd"]
    assert labels[12] == ["mpl"] and labels[13] == ["cc-by"]
    assert all(labels[100 + i] == [] for i in range(60))


def test_documents(spark, texts):
    for r in QUERIES["op9_license_scan"](spark, FOLDER).collect():
        words = words_of(texts[r["doc_id"]])
        places = base_places(words)
        at = [p for p, _ in places] or [None]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(words), len(places), min(at), max(at))
        assert r["base_labels"] == ",".join(sorted({BASE_PHRASES[p] for _, p in places}))


def scored(words, index):
    """Labels and score of one file, template by template and window by window."""
    labels, best = {BASE_PHRASES[p] for _, p in base_places(words)}, 0.0
    for (label, notice, phrase), entries in zip(TEMPLATES, index):
        template, key, total = notice.split(), phrase.split(), sum(entries.values())
        at = next(i for i in range(len(template)) if template[i : i + len(key)] == key)
        stands = [i - at for i in range(len(words)) if words[i : i + len(key)] == key]
        votes = [(i - p, p) for p in entries for i, w in enumerate(words) if w == template[p]]
        for half in (0, SHIFT // 2):
            for window in {(start + half) // SHIFT for start in stands}:
                met = {p for start, p in votes if (start + half) // SHIFT == window}
                score = sum(entries[p] for p in sorted(met)) / total
                if score >= MIN_SCORE - 1e-12:
                    labels.add(label)
                    best = max(best, score)
    return sorted(labels), min(best, 1.0)


def filler(rng, n):
    return " ".join(rng.choice("some ordinary words of a plain text in which the software and copy may appear".split()) for _ in range(n))


def test_labels_and_scores_against_single_windows(spark):
    rng, rows = random.Random(8), []
    for i in range(120):
        parts = []
        for _, notice, _ in rng.sample(TEMPLATES, rng.randint(0, 3)):
            words = notice.split()
            for _ in range(rng.choice([0, 0, 1, 4])):
                at = rng.randrange(len(words))
                words[at : at + rng.randint(0, 1)] = rng.choice([[], ["x"], ["the", "y"]])
            parts += [filler(rng, rng.randint(0, 12)), " ".join(words)]
        rows.append((i, " ".join([*parts, filler(rng, 5)]).upper() if i % 3 else ". ".join(parts)))
    everything = filler(rng, 9).join(f" {notice} " for _, notice, _ in TEMPLATES)
    rows += [(500, everything), (501, "license software copyright " * 2000 + everything), (502, "mit license " * 300)]
    rows += [(1000 + i, filler(rng, 40)) for i in range(100)]
    table = spark.createDataFrame(rows, "doc_id int, text string")
    vocabulary = sorted({w for _, notice, _ in TEMPLATES for w in notice.split()})
    index = index_words(*frequencies(table, vocabulary))
    got = {r["doc_id"]: r for r in license_labels(table).collect()}
    for doc_id, text in rows:
        labels, score = scored(words_of(text), index)
        assert got[doc_id]["labels"] == labels, doc_id
        assert math.isclose(got[doc_id]["score"], score, abs_tol=1e-9)
    assert got[500]["labels"] == sorted({label for label, *_ in TEMPLATES})


def test_slightly_altered_notices_are_found(spark):
    """Notices with one word in ten replaced, put in or left out, outside of the key phrase."""
    rng, rows, wanted = random.Random(21), [], {}
    for i in range(300):
        label, notice, phrase = TEMPLATES[i % len(TEMPLATES)]
        before, _, after = notice.partition(phrase)
        sides = [before.split(), after.split()]
        for _ in range(round(len(notice.split()) / 10)):
            side = rng.choice([s for s in sides if s] or [[""]])
            at = rng.randrange(len(side))
            side[at : at + 1] = rng.choice([["other"], [], [side[at], "also"]])
        text = " ".join([filler(rng, 30), *sides[0], phrase, *sides[1], filler(rng, 30)])
        rows.append((i, text))
        wanted[i] = label
    rows += [(1000 + i, filler(rng, 60)) for i in range(300)]
    got = {r["doc_id"]: r["labels"] for r in license_labels(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    recall = sum(label in got[i] for i, label in wanted.items()) / len(wanted)
    assert recall >= 0.9 and not any(got[1000 + i] for i in range(300))
    print(f"recall of altered notices: {recall:.3f}")


def test_rare_words_are_indexed(docs, texts):
    vocabulary = sorted({w for _, notice, _ in TEMPLATES for w in notice.split()})
    n, counts = frequencies(docs, vocabulary)
    assert n == len(texts)
    found = {w: sum(w in set(words_of(t)) for t in texts.values()) for w in vocabulary}
    assert counts == {w: c for w, c in found.items() if c}
    for (_, notice, _), entries in zip(TEMPLATES, index_words(n, counts)):
        words = notice.split()
        least = min(entries.values())
        assert all(n >= 0 for n in entries) and len({words[i] for i in entries}) <= 5 and least > 0


def test_hard_rows(hard, clashing, nothing):
    for table in (hard, clashing):
        got = license_labels(table).collect()
        assert len(got) == table.count()
        assert {r["doc_id"]: r["labels"] for r in got}[9] == ["mit"]
    assert license_labels(nothing).count() == 0


def test_no_python_in_the_plan(docs):
    plan = license_labels(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
