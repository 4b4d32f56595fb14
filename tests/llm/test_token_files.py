import random
import zlib

import numpy as np
import pyarrow.orc
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fairwake.llm.catalog import QUERIES
from fairwake.llm.common import scratch, tokenizer_path
from fairwake.llm.token_files import checksums, read_ids, with_start, write_ids

FOLDER = "/root/testdata/sf0.001"


def expected(texts):
    """doc_id -> (start, n_tokens, crc), one document after the other."""
    reference, at, out = Tokenizer.from_file(tokenizer_path()), 0, {}
    for doc_id in sorted(texts):
        ids = [*reference.encode(texts[doc_id] or "", add_special_tokens=False).ids, 0]
        out[doc_id] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    return out


def stored(spark, table, **options):
    path = scratch(spark, "test-token-files")
    write_ids(table, tokenizer_path(), path, **options)
    return path


def files_of(spark, path):
    names = spark.read.orc(path).select(F.input_file_name().alias("f")).distinct().collect()
    return sorted(r["f"].removeprefix("file://") for r in names)


def listed(spark, path):
    rows = read_ids(spark, path)
    return with_start(checksums(rows), rows).collect()


def test_documents(spark, texts):
    rows = QUERIES["op11_token_files"](spark, FOLDER).collect()
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows} == expected(texts)


@pytest.fixture(scope="module")
def many(spark):
    """Short texts with ids in steps of seven, mixed over the input's partitions."""
    ids = list(range(0, 140_000, 7))
    random.Random(3).shuffle(ids)
    return spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id bigint, text string").repartition(6)


def test_files_are_in_order_and_carry_their_index(spark, many):
    path = stored(spark, many, files=4)
    files = files_of(spark, path)
    assert 2 <= len(files) <= 4
    seen, last = [], -1
    for name in files:
        orc = pyarrow.orc.ORCFile(name)
        ids = orc.read(["doc_id"]).column("doc_id").to_pylist()
        assert ids == sorted(ids)
        seen.append((ids[0], ids[-1]))
        assert orc.row_index_stride == 2000 and orc.compression == "ZSTD"
    for low, high in sorted(seen):
        assert low > last
        last = high


def test_lookups_skip_row_groups(spark, many):
    path = stored(spark, many, files=2)
    one = read_ids(spark, path).where("doc_id = 70007")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,70007)" in plan
    assert [r["doc_id"] for r in one.collect()] == [70007]
    # between two ids of a row group only the Bloom filter can tell that none is there
    assert read_ids(spark, path).where("doc_id = 70008").count() == 0
    narrow = read_ids(spark, path).select("doc_id", "n_tokens").where("doc_id < 70")
    assert "ids" not in narrow._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    assert narrow.count() == 10


def test_bloom_filter_is_written(spark, many):
    path = stored(spark, many, files=1)
    jvm = spark._jvm
    (name,) = files_of(spark, path)
    options = jvm.org.apache.orc.OrcFile.readerOptions(spark._jsc.hadoopConfiguration())
    reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(name), options)
    footer = reader.rows().readStripeFooter(reader.getStripes().get(0))
    kinds = {footer.getStreams(i).getKind().toString() for i in range(footer.getStreamsCount())}
    assert "ROW_INDEX" in kinds and "BLOOM_FILTER_UTF8" in kinds
    encodings = {footer.getColumns(i).getKind().toString() for i in range(footer.getColumnsCount())}
    assert "DIRECT_V2" in encodings  # the second integer run-length encoding


def test_same_rows_in_any_number_of_files(spark, many):
    one, several = (stored(spark, many, files=n) for n in (1, 5))
    assert sorted((r["doc_id"], r["start"]) for r in listed(spark, one)) == sorted(
        (r["doc_id"], r["start"]) for r in listed(spark, several)
    )


def test_hard_rows(spark, hard, clashing, nothing):
    once = hard.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    texts = {r["doc_id"]: r["text"] for r in once.collect()}
    rows = listed(spark, stored(spark, once))
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows} == expected(texts)
    for table in (hard, clashing):
        rows = sorted(listed(spark, stored(spark, table)), key=lambda r: r["start"])
        ids = [r["doc_id"] for r in rows]
        assert ids == sorted((r["doc_id"] for r in table.collect()), key=lambda i: (i is not None, i or 0))
        at = 0
        for r in rows:  # gapless
            assert r["start"] == at
            at += r["n_tokens"]
    assert listed(spark, stored(spark, nothing)) == []


def test_one_id_for_all_rows_is_spread(spark):
    rows = spark.range(4000).selectExpr("5 AS doc_id", "concat('row ', id) AS text")
    path = stored(spark, rows, files=4)
    counts = [r["count"] for r in read_ids(spark, path).groupBy("file").count().collect()]
    assert len(counts) == 4 and max(counts) < 2000
