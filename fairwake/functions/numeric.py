"""Decimal arithmetic, ratios, averages, grades and their text forms.

Rounding always happens on decimals (half away from zero). Rounding a double
would make the result depend on its binary representation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from fairwake.schemas import NUM

# Lowest score of each grade, in percent.
GRADES = [(99, "A+"), (80, "A"), (60, "B"), (40, "C"), (20, "D")]
LOWEST_GRADE = "F"


def num(c: Column) -> Column:
    """Decimal value, NULL where the input has none."""
    return c.try_cast(NUM)


def rounded(c: Column, digits: int) -> Column:
    return num(F.round(num(c), digits))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a decimal, NULL where whole is zero."""
    return num(F.try_divide(num(part), num(whole)))


def percent(part: Column, whole: Column) -> Column:
    return num(ratio(part, whole) * F.lit(100).cast("decimal(3,0)"))


def mean(c: Column) -> Column:
    """Average over a group, NULL values left out."""
    return num(F.try_divide(F.sum(c).cast("double"), F.count(c)))


def mean_over(c: Column, window: WindowSpec) -> Column:
    """Average over a window frame, NULL values left out."""
    total, n = F.sum(c).over(window), F.count(c).over(window)
    return num(F.try_divide(total.cast("double"), n))


def plain_text(c: Column, digits: int) -> Column:
    """Rounded number as text without trailing zeros: 100, 33.3."""
    return F.regexp_replace(F.round(num(c), digits).cast("string"), r"\.?0+$", "")


def pct_text(c: Column, digits: int) -> Column:
    return F.concat(plain_text(c, digits), F.lit("%"))


def grade(score: Column) -> Column:
    """Letter grade of a percentage; NULL and anything below D is F."""
    out = F
    for lowest, letter in GRADES:
        out = out.when(score >= lowest, F.lit(letter))
    return out.otherwise(F.lit(LOWEST_GRADE))
