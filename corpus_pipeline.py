"""From raw documents to packed training windows, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes it as Parquet
below the shared folder and reads it again as the next stage's documents, so a stage starts
from files whatever happened to the executors of the one before. All but the last return
the columns of documents, extra ones included.

Documents without a letter (NULL, empty and blank texts among them) go with the language
stage; the stages after it take them all the same. NULL ids and other NULL columns are
carried, repeated rows count as copies, very long texts are read whole, and an empty table
passes as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fairwake.llm.common import documents, tokenizer_path, written
from fairwake.llm.exact_dedup import without_copies
from fairwake.llm.langid import with_known_language
from fairwake.llm.packing import pack
from fairwake.llm.secrets import without_secrets
from fairwake.llm.simhash import one_of_each


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised go on; a text without a letter has none."""
    return with_known_language(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts goes on, the longest; NULL equals empty."""
    return without_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies goes on.

    A text without a word is near others of that kind. Documents without an id go on.
    """
    return one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents go on, with secrets masked; NULL texts stay NULL."""
    return without_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document, with its place in the windows; a NULL text is an end mark."""
    return pack(docs, tokenizer_path(), with_ids=False)


STAGES = [
    ("language", language),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("secrets", secrets),
    ("packing", packing),
]

# Trained models, components and tokens are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
