"""Row numbers, look-ahead and running sums along each vessel's time line.

A plain window over a vessel puts the vessel's whole history into one task, and one
vessel may hold a large share of all rows. Here a time line is cut into slices of a
few hours. Rows are shuffled once by (vessel, slice) and ordered inside their slice;
what crosses a slice border (the first row and the number of rows or marks of each
slice) is carried by a table with one row per vessel and slice, which is joined back
on the same key and therefore moves no wide row again.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairwake.sources import tables

SLICE = "_slice"
SLICE_HOURS = 6
# A slice with more rows than this is split further, into so many parts of about equal counts.
CROWDED_ROWS = 100_000
PARTS = 256


class Slices(NamedTuple):
    """How time lines are cut: by hours, and crowded slices also at the times in `hot`."""

    hours: int = SLICE_HOURS
    hot: DataFrame | None = None  # key, _slice, _bounds


def counted_slices(
    df: DataFrame, key: str, time: str, hours: int = SLICE_HOURS, crowded: int = CROWDED_ROWS
) -> Slices:
    """Count the rows of each slice and find where to split the crowded ones.

    One identity that many ships share may hold a large share of all rows within hours.
    Only key and time are read. Counts and quantiles combine before their shuffles, and the
    table of crowded slices has one row for at least `crowded` rows.
    """
    spark, rows = df.sparkSession, _placed(df.select(key, time), key, time, hours)

    def kept(found: DataFrame, name: str) -> DataFrame:
        path = tables.new_folder(spark, name)
        found.write.parquet(path)
        return spark.read.schema(found.schema).parquet(path)

    counts = rows.groupBy(key, SLICE).count().where(F.col("count") > crowded)
    hot = kept(counts.select(key, SLICE), "crowded-slices")
    if hot.isEmpty():
        return Slices(hours)
    shares = F.array(*[F.lit(i / PARTS) for i in range(1, PARTS)])
    bounds = F.percentile_approx(F.unix_micros(time), shares, 10 * PARTS)
    split = rows.join(hot, [key, SLICE]).groupBy(key, SLICE).agg(F.array_distinct(bounds).alias("_bounds"))
    return Slices(hours, kept(split, "slice-bounds"))


def _placed(df: DataFrame, key: str, time: str, hours: int) -> DataFrame:
    slice_no = F.expr(f"floor(unix_seconds({time}) / {hours * 3600})")
    return df.withColumn(SLICE, slice_no).where(F.col(key).isNotNull() & F.col(SLICE).isNotNull())


def sliced(df: DataFrame, key: str, time: str, slices: int | Slices = SLICE_HOURS) -> DataFrame:
    """Add the slice number and spread the rows by key and slice.

    `slices` is a number of hours, or comes from `counted_slices`. Rows of one time always
    stay in one slice. Rows without key or time have no place on a time line and are left
    out. Saying so before the shuffle, and not leaving it to the later join, keeps the
    shuffled rows the same for both of their uses, so that they are shuffled once.
    """
    if not isinstance(slices, Slices):
        slices = Slices(slices)
    placed = _placed(df, key, time, slices.hours)
    if slices.hot is not None:
        part = f"coalesce(size(filter(_bounds, b -> b <= unix_micros({time}))), 0)"
        placed = (
            placed.join(slices.hot, [key, SLICE], "left")
            .withColumn(SLICE, F.expr(f"{SLICE} * {PARTS} + {part}"))
            .select(*df.columns, SLICE)
        )
    return placed.repartition(F.col(key), F.col(SLICE))


def with_next(
    rows: DataFrame,
    key: str,
    order: list[str],
    carry: list[str],
    *,
    into: str = "next",
    number: str | None = None,
) -> DataFrame:
    """Add the following row's `carry` columns as a struct, NULL after the last row.

    `rows` comes from `sliced`. With `number`, also add the row's number within its
    key, counted from 1.
    """
    in_slice = Window.partitionBy(key, SLICE).orderBy(*order)
    whole_slice = Window.partitionBy(key, SLICE)
    placed = (
        rows.withColumn("_position", F.row_number().over(in_slice))
        .withColumn("_rows", F.count(F.lit(1)).over(whole_slice))
        .withColumn("_following", F.lead(F.struct(*carry)).over(in_slice))
    )

    slices = Window.partitionBy(key).orderBy(SLICE)
    before = slices.rowsBetween(Window.unboundedPreceding, -1)
    borders = placed.where("_position = 1").select(
        key,
        SLICE,
        F.lead(F.struct(*carry)).over(slices).alias("_first_of_next_slice"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
    )

    joined = placed.join(borders, [key, SLICE]).withColumn(
        into, F.coalesce("_following", "_first_of_next_slice")
    )
    if number is not None:
        joined = joined.withColumn(number, F.col("_rows_before") + F.col("_position"))
    return joined.drop(
        "_position", "_rows", "_following", "_first_of_next_slice", "_rows_before"
    )


def with_changes(
    rows: DataFrame,
    key: str,
    order: list[str],
    label: str,
    *,
    changed: str = "seg_chg",
    changes: str = "segid",
    peers: list[str] | None = None,
) -> DataFrame:
    """Mark rows whose label differs from the next row's, and count the marks so far.

    The other columns decide between rows that are equal in `order`. With that, the table
    of slice borders reads the same columns as the rows do, so both share one shuffle;
    callers should drop columns that they do not need beforehand.

    `changed` is 1 where the next row has another label, 0 where it has the same one
    and NULL where there is no next row or a label is unknown. `changes` is the sum of
    the marks up to and including the row, NULL until there is one; rows that are equal
    in the `peers` columns (the first ones of `order`, time among them) all get the sum
    that includes every one of them. `rows` comes from `sliced`.
    """
    others = [c for c in rows.columns if c not in (key, SLICE, *order)]
    in_slice = Window.partitionBy(key, SLICE).orderBy(*order, *others)
    whole_slice = Window.partitionBy(key, SLICE)
    placed = (
        rows.withColumn("_position", F.row_number().over(in_slice))
        .withColumn("_last", F.lead(F.lit(1)).over(in_slice).isNull())
        .withColumn("_mark", _differs(F.col(label), F.lead(label).over(in_slice)))
    )
    measured = placed.withColumn("_marks", F.sum("_mark").over(whole_slice)).withColumn(
        "_last_label", F.max(F.when(F.col("_last"), F.col(label))).over(whole_slice)
    )

    slices = Window.partitionBy(key).orderBy(SLICE)
    before = slices.rowsBetween(Window.unboundedPreceding, -1)
    borders = (
        measured.where("_position = 1")
        .select(
            key,
            SLICE,
            "_marks",
            _differs(F.col("_last_label"), F.lead(label).over(slices)).alias("_last_mark"),
        )
        .withColumn("_slice_marks", _sum_known("_marks", "_last_mark"))
        .select(key, SLICE, "_last_mark", F.sum("_slice_marks").over(before).alias("_marks_before"))
    )

    so_far = (Window.unboundedPreceding, Window.currentRow)
    if peers is None:
        counted = in_slice.rowsBetween(*so_far)
    else:
        counted = Window.partitionBy(key, SLICE).orderBy(*peers).rangeBetween(*so_far)
    return (
        placed.join(borders, [key, SLICE])
        .withColumn(changed, F.when(F.col("_last"), F.col("_last_mark")).otherwise(F.col("_mark")))
        .withColumn("_marks_within", F.sum(changed).over(counted))
        .withColumn(changes, _sum_known("_marks_before", "_marks_within"))
        .drop("_position", "_last", "_mark", "_last_mark", "_marks_before", "_marks_within")
    )


def _differs(label: Column, following: Column) -> Column:
    return (label != following).cast("bigint")


def _sum_known(a: str, b: str) -> Column:
    return F.coalesce(F.col(a) + F.col(b), F.col(a), F.col(b))
