"""Stage 1: raw position messages to the message table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairwake.functions.area import AREA, Box, region_label
from fairwake.functions.numeric import num
from fairwake.schemas import MESSAGES, MESSAGES_LEGACY, conform
from fairwake.sources.tables import scan_since


def format_messages(source: DataFrame) -> DataFrame:
    """Typed message columns; values that do not convert become NULL."""
    return source.select(
        F.col("ssvid").try_cast("bigint").alias("mmsi"),
        "timestamp",
        "lon",
        "lat",
        num(F.col("speed_knots")).alias("speed_knots"),
        num(F.col("implied_speed_knots")).alias("implied_speed_knots"),
        "source",
    )


def ingest(
    source: DataFrame,
    since: dt.datetime,
    box: Box = AREA,
    *,
    label_region: bool = True,
) -> DataFrame:
    """Messages inside the box from days after the watermark."""
    fresh = scan_since(source, "date", since)
    inside = format_messages(fresh.where(box.contains(F.col("lon"), F.col("lat"))))
    if not label_region:
        return conform(inside, MESSAGES_LEGACY)
    labelled = inside.withColumn("region", region_label(F.col("lon"), F.col("lat")))
    return conform(labelled, MESSAGES)
