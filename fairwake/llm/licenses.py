"""Licence scan with a positional index of rare words.

Each template is a notice in words. From all documents the document frequency of every
template word is counted. The rarest words of each template are its index entries: word ->
(template, position, IDF). A file is scanned once for the indexed words; each of them looks
up its postings, and a posting votes for (template, place in the file minus position in the
template). Votes meet in windows of `SHIFT` places that overlap by half, so a notice with up
to half as many words put in or left out still aligns. In a window each entry counts once;
their IDFs' share of the template's is the score. A template counts if its best window
reaches `MIN_SCORE` and its key phrase stands, word for word, in that window.

Everything is built-in functions. Texts stay where they are: only the places of indexed
words leave the scan, and votes combine before their shuffle. The index is as large as the
templates, so it is broadcast; the frequencies are as many. A row of votes holds the entries
of one template at most.

Words are runs of letters, digits and all characters beyond ASCII; A to Z count as lower
case. NULL texts are empty texts without labels. NULL ids and repeated rows are carried
through; an empty table gives no rows; a very long text is scanned whole. Ties change
nothing: labels are sets. Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairwake.llm.common import text_of, written

WORD_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Phrases that are always reported, with their labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Label, notice in words, key phrase that must stand within it.
TEMPLATES = (
    ("mit", "released under the mit license", "the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software"
        " and associated documentation files",
        "permission is hereby granted free of charge",
    ),
    ("apache", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("gpl", "licensed under the gnu general public license version 3", "gnu general public license"),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the"
        " gnu general public license as published by the free software foundation",
        "gnu general public license as published",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted"
        " provided that the following conditions are met",
        "redistribution and use in source and binary forms",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee"
        " is hereby granted",
        "permission to use copy modify",
    ),
    ("mpl", "subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    (
        "cc-by-sa",
        "licensed under a creative commons attribution sharealike 4 0 international license",
        "creative commons attribution sharealike",
    ),
    (
        "cc0",
        "to the extent possible under law the author has dedicated all copyright and related and neighboring rights"
        " to this software to the public domain worldwide",
        "related and neighboring rights",
    ),
    (
        "mit",
        "the software is provided as is without warranty of any kind express or implied including but not limited to"
        " the warranties of merchantability fitness for a particular purpose and noninfringement",
        "the software is provided as is without warranty of any kind",
    ),
    (
        "apache",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at"
        " http www apache org licenses license 2 0",
        "www apache org licenses license 2 0",
    ),
    (
        "bsd",
        "this software is provided by the copyright holders and contributors as is and any express or implied"
        " warranties including but not limited to the implied warranties of merchantability and fitness for a"
        " particular purpose are disclaimed",
        "by the copyright holders and contributors as is",
    ),
    (
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser"
        " general public license as published by the free software foundation",
        "gnu lesser general public license",
    ),
    (
        "agpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero"
        " general public license as published by the free software foundation",
        "gnu affero general public license",
    ),
    (
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be"
        " held liable for any damages arising from the use of this software",
        "in no event will the authors be held liable",
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        "free and unencumbered software",
    ),
    (
        "epl",
        "this program and the accompanying materials are made available under the terms of the eclipse public license",
        "eclipse public license",
    ),
    ("boost", "distributed under the boost software license version 1 0", "boost software license version 1 0"),
    ("mit", "spdx license identifier mit", "spdx license identifier mit"),
    ("apache", "spdx license identifier apache 2 0", "spdx license identifier apache 2 0"),
    ("bsd", "spdx license identifier bsd 3 clause", "spdx license identifier bsd 3 clause"),
)
INDEX_WORDS = 5  # indexed words of a template: its rarest ones
SHIFT = 8  # places of a file in which the votes for one alignment meet
MIN_SCORE = 0.6


def _lower_ascii(word: Column) -> Column:
    """The word in lower case if it is ASCII; else something that no template contains."""
    low = F.lower(word)
    return F.when(F.octet_length(low) == F.octet_length(word), low)


def _words(text_column: str) -> Column:
    return F.filter(F.split(text_of(text_column), WORD_GAP), lambda w: w != "")


def frequencies(docs: DataFrame, words: list[str], text_column: str = "text") -> tuple[int, dict[str, int]]:
    """Number of documents, and of those with each of the given words."""
    found = F.array_distinct(F.filter(F.transform(_words(text_column), _lower_ascii), lambda w: w.isin(words)))
    counts = (
        docs.select(F.explode(F.array_append(found, F.lit(""))).alias("word")).groupBy("word").count().collect()
    )
    by_word = {row["word"]: row["count"] for row in counts}
    return by_word.pop("", 0), by_word


def index_words(documents: int, counts: dict[str, int]) -> list[dict[int, float]]:
    """For each template: position -> IDF of its indexed words."""
    idf = lambda word: math.log((documents + 2) / (counts.get(word, 0) + 1))
    chosen = []
    for _, notice, _ in TEMPLATES:
        words = notice.split()
        first = {w: i for i, w in reversed(list(enumerate(words)))}
        rare = sorted(first, key=lambda w: (-idf(w), w))[:INDEX_WORDS]
        chosen.append({i: idf(w) for i, w in enumerate(words) if w in rare})
    return chosen


def license_labels(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, base, base_labels, labels, score.

    base is an array of structs (phrase, place), in the order of place; labels are sorted
    arrays; score is the best share of a template whose key phrase stands (0 without one).
    """
    spark = docs.sparkSession
    vocabulary = sorted({w for _, notice, _ in TEMPLATES for w in notice.split()})
    documents, counts = frequencies(docs, vocabulary, text_column)
    index = index_words(documents, counts)

    idf_of: dict[str, float] = {}
    postings: list[tuple[str, int, int, float, int]] = []  # key, template, position, share, phrases
    for number, ((_, notice, phrase), entries) in enumerate(zip(TEMPLATES, index)):
        words, total = notice.split(), sum(entries.values()) or 1.0
        for position, idf in entries.items():
            postings.append((words[position], number, position, idf / total, 0))
            idf_of[words[position]] = idf
        parts = phrase.split()
        start = next(i for i in range(len(words)) if words[i : i + len(parts)] == parts)
        postings.append((f"#{phrase}", number, start, 0.0, 1))

    # each phrase is looked for around its rarest indexed word or, without one, its last word
    phrases = list(dict.fromkeys([*BASE_PHRASES, *(phrase for *_, phrase in TEMPLATES)]))
    anchors = {}
    for phrase in phrases:
        parts = phrase.split()
        at = max(range(len(parts)), key=lambda i: (idf_of.get(parts[i], -1.0), i))
        anchors[phrase] = (parts, at)
    scanned = sorted({*idf_of, *(parts[at] for parts, at in anchors.values())})

    worded = docs.select(
        F.col(id_column).alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        _words(text_column).alias("words"),
    )
    hits = worded.withColumn(
        "hits",
        F.filter(
            F.transform("words", lambda w, i: F.struct(_lower_ascii(w).alias("word"), i.alias("place"))),
            lambda h: h["word"].isin(scanned),
        ),
    )

    def places(phrase: str) -> Column:
        parts, at = anchors[phrase]

        def stands(hit: Column) -> Column:
            test = hit["word"] == parts[at]
            for i, part in enumerate(parts):
                if i != at:
                    test = test & (hit["place"] + (i - at) >= 0)
                    test = test & (_lower_ascii(F.get(F.col("words"), F.greatest(hit["place"] + (i - at), F.lit(0)))) == part)
            return F.coalesce(test, F.lit(False))

        return F.transform(
            F.filter("hits", stands),
            lambda h: F.struct((h["place"] - at).alias("place"), F.lit(phrase).alias("phrase")),
        )

    phrased = hits.select(
        "row",
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        "hits",
        F.when(F.size("hits") > 0, F.flatten(F.array(*(places(p) for p in phrases))))
        .otherwise(F.array().cast("array<struct<place:int,phrase:string>>"))
        .alias("phrases"),
    )
    base = list(BASE_PHRASES)
    nothing = F.array().cast("array<struct<key:string,place:int>>")
    narrow = written(
        phrased.select(
            "row",
            "doc_id",
            "n_words",
            F.sort_array(F.filter("phrases", lambda p: p["phrase"].isin(base))).alias("base"),
            F.when(
                F.size("phrases") > 0,
                F.concat(
                    F.transform(
                        F.filter("hits", lambda h: h["word"].isin(sorted(idf_of))),
                        lambda h: F.struct(h["word"].alias("key"), h["place"].alias("place")),
                    ),
                    F.transform(
                        "phrases", lambda p: F.struct(F.concat(F.lit("#"), p["phrase"]).alias("key"), p["place"].alias("place"))
                    ),
                ),
            )
            .otherwise(nothing)
            .alias("found"),
        ),
        "license-rows",
    )
    table = spark.createDataFrame(postings, "key string, template int, position int, share double, phrases int")
    labels = spark.createDataFrame(
        [(i, label) for i, (label, *_) in enumerate(TEMPLATES)], "template int, label string"
    )
    start = F.col("place") - F.col("position")
    windows = F.array(*(F.floor((start + half) / SHIFT) * 2 + half // (SHIFT // 2) for half in (0, SHIFT // 2)))
    aligned = (
        narrow.where("size(found) > 0")
        .select("row", F.explode("found").alias("f"))
        .select("row", F.col("f.key").alias("key"), F.col("f.place").alias("place"))
        .join(F.broadcast(table), "key")
        .select("row", "template", F.struct("position", "share", "phrases").alias("entry"), F.explode(windows).alias("window"))
        .groupBy("row", "template", "window")
        .agg(F.sort_array(F.collect_set("entry")).alias("entries"))
        .where(F.exists("entries", lambda e: e["phrases"] > 0))
        .withColumn("score", F.aggregate("entries", F.lit(0.0), lambda total, e: total + e["share"]))
        .where(F.col("score") >= MIN_SCORE)
        .join(F.broadcast(labels), "template")
        .groupBy("row")
        .agg(F.collect_set("label").alias("found_labels"), F.max("score").alias("score"))
    )
    label_of = F.create_map(*(F.lit(x) for pair in BASE_PHRASES.items() for x in pair))
    base_labels = F.array_sort(F.array_distinct(F.transform("base", lambda b: F.element_at(label_of, b["phrase"]))))
    none = F.array().cast("array<string>")
    return (
        narrow.drop("found")
        .join(aligned, "row", "left")
        .select(
            "doc_id",
            "n_words",
            "base",
            base_labels.alias("base_labels"),
            F.array_sort(F.array_union(base_labels, F.coalesce("found_labels", none))).alias("labels"),
            F.least(F.coalesce("score", F.lit(0.0)), F.lit(1.0)).alias("score"),
        )
    )
