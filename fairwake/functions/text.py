"""Text helpers for reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names in reports.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


def month_name(month: Column) -> Column:
    return F.get(F.array([F.lit(m) for m in MONTHS]), month.cast("int") - 1)


def listed(values: Column) -> Column:
    """An array of values as one text, ascending, separated by comma and blank."""
    return F.when(F.size(values) > 0, F.array_join(F.array_sort(values), ", "))
