"""The sliced time line gives what one window per vessel would give."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from fairwake.operators.ordered import SLICE, counted_slices, sliced, with_changes, with_next


def positions(spark):
    """One vessel holds a third of the rows; others are sparse or have one row."""
    hot = spark.range(400).selectExpr("0L as mmsi", "id * 977 % 200000 as s", "id as v")
    sparse = spark.range(800).selectExpr("1 + id % 37 as mmsi", "id * 7919 % 900000 as s", "id as v")
    single = spark.range(1).selectExpr("99L as mmsi", "5L as s", "0L as v")
    rows = hot.unionByName(sparse).unionByName(single)
    return rows.selectExpr(
        "mmsi", "timestamp_seconds(1704067200 + s) as timestamp", "v",
        "case when v % 5 = 0 then null else (s div 4000) % 3 end as label",
    )


def collected(df, *columns):
    return sorted(map(tuple, df.select("mmsi", "v", *columns).collect()), key=str)


def test_next_row_and_number(spark):
    rows = positions(spark)
    order = ["timestamp", "v"]
    for hours in (1, 6, 1000):
        found = with_next(sliced(rows, "mmsi", "timestamp", hours), "mmsi", order, ["v", "label"], number="num")
        w = Window.partitionBy("mmsi").orderBy(*order)
        plain = rows.withColumn("num", F.row_number().over(w)).withColumn(
            "next", F.lead(F.struct("v", "label")).over(w)
        )
        assert collected(found, "num", "next") == collected(plain, "num", "next")


def plain_changes(rows, peers):
    w = Window.partitionBy("mmsi").orderBy("timestamp", "v")
    following = F.lead("label").over(w)
    flagged = rows.withColumn("seg_chg", (F.col("label") != following).cast("bigint"))
    if peers:
        so_far = Window.partitionBy("mmsi").orderBy("timestamp").rangeBetween(Window.unboundedPreceding, 0)
    else:
        so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    return flagged.withColumn("segid", F.sum("seg_chg").over(so_far))


def test_changes(spark):
    rows = positions(spark).withColumn("label", F.coalesce("label", F.lit(7)))
    rows = rows.unionByName(rows.where("v % 11 = 3").withColumn("v", F.col("v") + 10000))  # equal times
    for hours in (1, 6):
        cut = sliced(rows, "mmsi", "timestamp", hours)
        for peers in (["timestamp"], None):
            found = with_changes(cut, "mmsi", ["timestamp", "v"], "label", peers=peers)
            assert collected(found, "seg_chg", "segid") == collected(plain_changes(rows, peers), "seg_chg", "segid")


def test_changes_with_unknown_labels(spark):
    rows = positions(spark)
    found = with_changes(sliced(rows, "mmsi", "timestamp", 3), "mmsi", ["timestamp", "v"], "label")
    assert collected(found, "seg_chg", "segid") == collected(plain_changes(rows, None), "seg_chg", "segid")
    alone = found.where("mmsi = 99").first()
    assert alone["seg_chg"] is None and alone["segid"] is None


def test_hot_vessel_is_spread_over_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = sliced(positions(spark), "mmsi", "timestamp", 6).where("mmsi = 0")
        assert cut.select(F.spark_partition_id()).distinct().count() > 4
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_crowded_slice_is_split(spark):
    """200,000 rows of one identity within five hours, many of them at one second."""
    rows = spark.range(200_000).selectExpr(
        "7L as mmsi", "timestamp_seconds(1704067200 + if(id % 10 = 0, 9000, id % 18000)) as timestamp", "id as v",
        "id % 3 as label",
    ).unionByName(positions(spark))
    slices = counted_slices(rows, "mmsi", "timestamp", crowded=50_000)
    hot = slices.hot.collect()
    assert [r["mmsi"] for r in hot] == [7] and 100 < len(hot[0]["_bounds"]) < 256
    cut = sliced(rows, "mmsi", "timestamp", slices)
    sizes = [r["count"] for r in cut.where("mmsi = 7").groupBy(SLICE).count().collect()]
    assert len(sizes) > 100 and max(sizes) < 25_000  # a tenth of the rows share a second
    by_time = cut.groupBy("mmsi", "timestamp").agg(F.countDistinct(SLICE).alias("n"))
    assert by_time.agg(F.max("n")).first()[0] == 1

    found = with_next(cut, "mmsi", ["timestamp", "v"], ["v"], number="num")
    w = Window.partitionBy("mmsi").orderBy("timestamp", "v")
    plain = rows.withColumn("num", F.row_number().over(w)).withColumn("next", F.lead(F.struct("v")).over(w))
    columns = ["mmsi", "v", "num", "next"]
    assert found.select(columns).exceptAll(plain.select(columns)).isEmpty() and found.count() == plain.count()
    marked = with_changes(cut, "mmsi", ["timestamp", "v"], "label", peers=["timestamp"]).select("mmsi", "v", "seg_chg", "segid")
    expected = plain_changes(rows, ["timestamp"]).select("mmsi", "v", "seg_chg", "segid")
    assert marked.exceptAll(expected).isEmpty() and expected.exceptAll(marked).isEmpty()


def test_slices_that_are_not_crowded_stay(spark):
    assert counted_slices(positions(spark), "mmsi", "timestamp").hot is None


def test_no_window_runs_in_one_partition(spark):
    found = with_next(sliced(positions(spark), "mmsi", "timestamp"), "mmsi", ["timestamp"], ["v"])
    assert "SinglePartition" not in found._jdf.queryExecution().executedPlan().toString()
