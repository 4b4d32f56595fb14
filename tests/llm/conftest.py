import duckdb
import pytest
from pyspark.sql import DataFrame, SparkSession

FOLDER = "/root/testdata/sf0.001"
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "the quick brown fox and the lazy dog in a house. " * 3000  # 147,000 characters

# NULLs in every column, empty and blank texts, a very long one, ties and repeated rows
HARD = [
    (1, "", "en", "a", 0),
    (2, None, "en", "a", None),
    (3, " \t\n", None, None, 3),
    (4, "Éa b", "fr", "b", 4),
    (4, "Éa b", "fr", "b", 4),
    (5, "Éa  b", "fr", "b", 5),
    (6, LONG, "en", "b", len(LONG)),
    (7, LONG + " ", "en", "b", len(LONG)),
    (None, "Éa b", None, "c", 4),
    (None, None, None, None, None),
    (8, "1234 5678 \U0001f917 -- ==", "de", "c", 22),
    (9, 'x token = "24be64439e3e49cf46b2d7c90f3602a3" MIT License. ' + "la casa es de el y la luna. " * 20, "es", "d", 9),
]


@pytest.fixture(scope="session")
def hard(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(HARD, COLUMNS)


@pytest.fixture(scope="session")
def clashing(hard: DataFrame) -> DataFrame:
    """The same rows with columns named like those that operators make."""
    names = "row words key keep hash slot quality language guess full_hash text_hash spans ids rank step ROW part"
    out = hard
    for name in dict.fromkeys(n.lower() for n in names.split()):
        out = out.withColumn(name, hard["doc_id"])
    return out


@pytest.fixture(scope="session")
def nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def docs(spark: SparkSession) -> DataFrame:
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs: DataFrame) -> dict[int, str]:
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{FOLDER}/documents.parquet')")
    return con


def plain(df: DataFrame) -> list[tuple]:
    """Rows as sorted texts of sorted columns."""
    names = sorted(df.columns)
    return sorted(tuple(map(str, row)) for row in df.select(*names).collect())
