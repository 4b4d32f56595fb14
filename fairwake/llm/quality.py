"""Quality rules as one table of thresholds, compiled into one Spark projection.

Each rule names a measure of a text, a comparison and a limit. `quality` first derives the
measures with built-in functions, in a few projections, and then evaluates all rules of
the table in one further projection; there is no shuffle and no user function.

Words are runs of characters other than space and the controls 9 to 13. A window of three
words counts as repeated if its 64-bit hash occurs again in the same text. NULL texts are
empty texts: no words, so the base rule fails them. NULL ids and repeated rows are carried
through; every row is judged by its own text alone.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairwake.llm.common import fresh, text_of

WORD_GAP = r"[\x20\x09-\x0D]+"
WORD_CHARACTER = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

# Frequent function words of the languages the rules are meant for.
STOP_WORDS = {
    "en": "the be to of and a in that have it for on with as by is are was this from or an at not",
    "fr": "le la les de des du un une et est en que qui dans pour par sur pas avec au plus ce",
    "de": "der die das und ist von mit den dem ein eine zu nicht auf im für des sich als auch",
    "es": "el la los las de del un una y es en que por con para no se al como su más lo",
}


class Rule(NamedTuple):
    name: str
    measure: str
    comparison: str  # "<" or ">": the text fails if the measure is below or above the limit
    limit: float


RULES = (
    Rule("short_words", "mean_word_chars", "<", 2.0),
    Rule("long_words", "mean_word_chars", ">", 20.0),
    Rule("symbols", "symbol_ratio", ">", 0.25),
    Rule("few_stop_words", "stop_word_ratio", "<", 0.01),
    Rule("repeated_lines", "dup_line_ratio", ">", 0.5),
    Rule("few_letters", "letter_word_ratio", "<", 0.5),
)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def compiled(rules: tuple[Rule, ...] = RULES) -> Column:
    """The names of the rules that a row of measures breaks."""
    broken = []
    for rule in rules:
        value = F.col(rule.measure)
        fails = value < rule.limit if rule.comparison == "<" else value > rule.limit
        broken.append(F.when(fails, F.lit(rule.name)))
    return F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")


def _repeated_words() -> Column:
    """Words that stand in a window found twice or more.

    Window hashes are sorted together with their places, so equal windows are neighbours.
    `sorted_windows` and `windows` are columns of the projection below.
    """
    last = F.size("sorted_windows") - 1
    at = lambda i: F.get(F.col("sorted_windows"), i)["hash"]
    starts = F.filter(
        "sorted_windows",
        lambda w, i: ((i > 0) & (w["hash"] == at(F.greatest(i - 1, F.lit(0)))))
        | ((i < last) & (w["hash"] == at(i + 1))),
    )
    places = F.transform(starts, lambda w: F.array(w["place"], w["place"] + 1, w["place"] + 2))
    return F.size(F.array_distinct(F.flatten(places)))


def quality(docs: DataFrame, text_column: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All columns of `docs`, and last one struct column, named quality if that name is free.

    The struct has n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, the ratios
    that the rules use, failed (names of broken rules), base_failed and kept.
    """
    stop_words = sorted({w for words in STOP_WORDS.values() for w in words.split()})
    text = text_of(text_column)
    split = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.filter(F.split(text, WORD_GAP), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda s: s.rlike(WORD_CHARACTER)).alias("lines"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )
    hashed = split.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    counted = hashed.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda n, w: n + F.char_length(w)).alias("word_chars"),
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(stop_words))).cast("long").alias("n_stop"),
        F.size(F.filter("words", lambda w: w.rlike(r"\p{L}"))).cast("long").alias("n_letter_words"),
        F.when(
            F.size("hashes") > 2,
            F.transform(
                F.sequence(F.lit(0), F.size("hashes") - 3),
                lambda i: F.xxhash64(
                    F.get(F.col("hashes"), i), F.get(F.col("hashes"), i + 1), F.get(F.col("hashes"), i + 2)
                ),
            ),
        )
        .otherwise(F.array().cast("array<bigint>"))
        .alias("windows"),
    )
    # Texts without a repeated window, the most common case, are not sorted. The array goes
    # through a generator because a filter on the result would otherwise be pushed below
    # this projection and sort anew for every element that it looks at.
    ordered = F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("hash"), i.alias("place")))),
    ).otherwise(F.array().cast("array<struct<hash:bigint,place:int>>"))
    placed = counted.select("*", F.explode(F.array(ordered)).alias("sorted_windows"))
    measured = placed.select(
        "row",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        _repeated_words().cast("long").alias("n_repeat_words"),
        *(
            F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole)), F.lit(0.0)).alias(name)
            for name, part, whole in (
                ("mean_word_chars", "word_chars", "n_words"),
                ("symbol_ratio", "n_symbols", "word_chars"),
                ("stop_word_ratio", "n_stop", "n_words"),
                ("letter_word_ratio", "n_letter_words", "n_words"),
                ("dup_line_ratio", "n_dup_lines", "n_lines"),
            )
        ),
    )
    base = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    judged = measured.withColumns({"failed": compiled(rules), "base_failed": base})
    fields = [c for c in judged.columns if c != "row"]
    kept = ~F.col("base_failed") & (F.size("failed") == 0)
    return judged.select("row.*", F.struct(*fields, kept.alias("kept")).alias(fresh(docs, "quality")))
