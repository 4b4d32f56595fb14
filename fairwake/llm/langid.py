"""Language identification: multinomial naive Bayes over hashed character n-grams.

Features of a text are its runs of one to three characters in lower case, each hashed to
one of `BUCKETS` columns. Training counts them per language and adds one (Laplace); the
matrix of log probabilities has languages x BUCKETS entries whatever the corpus, and is
broadcast. Scoring works on a batch of texts at once: the texts' n-grams form a sparse
matrix in row form (column numbers and row bounds), which is multiplied with the matrix in
numpy, in slices of a bounded number of characters.

Training takes at most about `TRAIN_ROWS` labelled rows per language, chosen by the hash of
the id; priors come from all labelled rows. Whole texts are used, in training and scoring.

A text that is NULL or has no letter is `und` with score 0. So is every text if there is
nothing to learn from. The score is the posterior of the predicted language; of equal
languages the first by name is taken. NULL ids are scored like others and never train.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairwake.llm.common import fresh, small_batches

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
SLICE = 1 << 18  # characters whose n-grams are in memory at once
TRAIN_ROWS = 4000
UNKNOWN = "und"
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


class Model(NamedTuple):
    languages: list[str]
    log_prior: np.ndarray  # languages
    log_likelihood: np.ndarray  # BUCKETS x languages


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def columns_of(points: np.ndarray, order: int) -> np.ndarray:
    """The hashed column of each run of `order` code points."""
    n = len(points) - order + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    mixed = np.full(n, order, dtype=np.uint64)
    for i in range(order):
        mixed = (mixed ^ points[i : i + n].astype(np.uint64)) * MULTIPLIERS[i]
        mixed ^= mixed >> np.uint64(29)
    return (mixed >> np.uint64(48)).astype(np.int64) % BUCKETS


def slices(points: np.ndarray, order: int) -> Iterator[np.ndarray]:
    """The columns of all runs, a bounded number at a time."""
    for at in range(0, max(len(points) - order + 1, 0), SLICE):
        yield columns_of(points[at : at + SLICE + order - 1], order)


def _letters(text: str) -> bool:
    return any(map(str.isalpha, text))


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of each column per language, summed over a task before they are shuffled."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for language, text in zip(batch["language"], batch["text"]):
            total = sums.setdefault(language, np.zeros(BUCKETS, dtype=np.int64))
            points = code_points(text)
            for order in ORDERS:
                for found in slices(points, order):
                    total += np.bincount(found, minlength=BUCKETS)
    for language, total in sums.items():
        used = np.flatnonzero(total)
        yield pd.DataFrame({"language": language, "bucket": used, "n": total[used]})


def train(labelled: DataFrame, id_column: str, text_column: str, label_column: str, rows: int = TRAIN_ROWS) -> Model:
    """A model from rows with a label; the caller has removed what must not be learned from."""
    small_batches(labelled.sparkSession)
    usable = labelled.select(
        F.col(id_column).alias("id"), F.col(label_column).alias("language"), F.col(text_column).alias("text")
    ).where("id IS NOT NULL AND language IS NOT NULL AND text IS NOT NULL")
    counts = {r["language"]: r["count"] for r in usable.groupBy("language").count().collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], np.empty(0), np.empty((BUCKETS, 0)))
    share = F.create_map(*(F.lit(x) for k in languages for x in (k, min(1.0, rows / counts[k]))))
    draw = F.pmod(F.xxhash64(F.lit("train"), "id"), F.lit(1 << 30)) / float(1 << 30)
    summed = (
        usable.where(draw < F.element_at(share, F.col("language")))
        .select("language", "text")
        .mapInPandas(_counted, "language string, bucket long, n long")
        .groupBy("language", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()  # languages x BUCKETS numbers at most
    )
    table = np.ones((BUCKETS, len(languages)))
    place = {k: i for i, k in enumerate(languages)}
    np.add.at(table, (summed["bucket"].to_numpy(int), summed["language"].map(place).to_numpy(int)), summed["n"].to_numpy(float))
    prior = np.array([counts[k] for k in languages], dtype=float)
    return Model(languages, np.log(prior / prior.sum()), np.log(table / table.sum(axis=0)))


def scores(texts: list[str], model: Model) -> np.ndarray:
    """Log posteriors, not normalised: texts x languages."""
    out = np.tile(model.log_prior, (len(texts), 1))
    waiting: list[tuple[int, np.ndarray]] = []

    def add() -> None:
        # rows of the sparse matrix one after another, with their bounds
        bounds = np.cumsum([0, *(len(c) for _, c in waiting)])
        weights = model.log_likelihood[np.concatenate([c for _, c in waiting])]
        sums = np.add.reduceat(weights, bounds[:-1], axis=0)
        np.add.at(out, [i for i, _ in waiting], sums)
        waiting.clear()

    held = 0
    for i, text in enumerate(texts):
        points = code_points(text)
        for order in ORDERS:
            for found in slices(points, order):
                waiting.append((i, found))
                held += len(found)
                if held >= SLICE:
                    add()
                    held = 0
    if waiting:
        add()
    return out


def predictor(df: DataFrame, model: Model):
    """A column function: text -> struct(lang string, score double)."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for texts in batches:
            known = [bool(model.languages) and isinstance(t, str) and _letters(t) for t in texts]
            out = pd.DataFrame({"lang": [UNKNOWN] * len(texts), "score": 0.0})
            if any(known):
                logs = scores([t for t, k in zip(texts, known) if k], model)
                best = logs.argmax(axis=1)
                top = logs[np.arange(len(logs)), best]
                out.loc[known, "lang"] = [model.languages[b] for b in best]
                out.loc[known, "score"] = 1.0 / np.exp(logs - top[:, None]).sum(axis=1)
            yield out

    return predict


def held_out(id_column: str, folds: int = 4, fold: int = 2) -> Column:
    """Rows kept out of training: CRC-32 of the id as text. Not true for a NULL id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % folds == fold, F.lit(False))


def identify(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang"
) -> DataFrame:
    """All columns of `docs` and a struct column `language` (held_out, lang, score)."""
    model = train(docs.where(~held_out(id_column)), id_column, text_column, label_column)
    guess = fresh(docs, "guess")
    rows = docs.withColumn(guess, predictor(docs, model)(F.col(text_column)))
    return rows.select(
        *docs.columns,
        F.struct(
            held_out(id_column).alias("held_out"), F.col(f"{guess}.lang").alias("lang"), F.col(f"{guess}.score").alias("score")
        ).alias(fresh(docs, "language")),
    )


MIN_SCORE = 0.5


def with_known_language(docs: DataFrame) -> DataFrame:
    """The rows whose text has letters and a predicted language that is likelier than not."""
    found = identify(docs)
    name = found.columns[-1]
    kept = found.where((F.col(f"{name}.lang") != UNKNOWN) & (F.col(f"{name}.score") >= MIN_SCORE))
    return kept.select(*docs.columns)
