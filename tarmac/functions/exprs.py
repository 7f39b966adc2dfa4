"""Column expressions shared by the operators (PRJ-1..17).

All of these are built-in Catalyst expressions, so they stay inside
whole-stage codegen; nothing here is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def c(name: str) -> Column:
    return F.col(name)


def ravg(col: str | Column, digits: int = 2) -> Column:
    """``round(avg(col), digits)`` — the reference's report average."""
    return F.round(F.avg(col), digits)


def pct_rows(cond: Column, digits: int = 2) -> Column:
    """PRJ-16: share of the group's rows where ``cond`` holds, in percent.

    ``count(when(cond, True)) / count(*) * 100``; ``try_divide`` keeps a
    global aggregate over empty input null instead of failing under ANSI.
    """
    return F.round(F.try_divide(F.count_if(cond), F.count(F.lit(1))) * 100, digits)


def pct_of_total(cond: Column, total: Column, digits: int = 2) -> Column:
    """Share of ``total`` rows where ``cond`` holds, in percent."""
    return F.round(F.try_divide(F.count_if(cond), total) * 100, digits)


def flag(cond: Column) -> Column:
    return F.when(cond, 1.0).otherwise(0.0)


# Calendar groups behind the season flags (PRJ-4, PRJ-7).
WEEKEND_DAYS = [1, 7]
SUMMER_MONTHS = [6, 7, 8]
HOLIDAY_MONTHS = [11, 12]
WINTER_MONTHS = [12, 1, 2]
PEAK_QUARTERS = [2, 3]


def season_flags(month: Column, day_of_week: Column) -> dict[str, Column]:
    """PRJ-4: is_weekend, is_summer, is_holiday_season, is_winter as 1.0/0.0."""
    return {
        "is_weekend": flag(day_of_week.isin(WEEKEND_DAYS)),
        "is_summer": flag(month.isin(SUMMER_MONTHS)),
        "is_holiday_season": flag(month.isin(HOLIDAY_MONTHS)),
        "is_winter": flag(month.isin(WINTER_MONTHS)),
    }


def dep_hour(crs_dep_time: Column) -> Column:
    """PRJ-3: scheduled departure hour; 2400 gives 24.0."""
    return F.floor(crs_dep_time.cast("double") / 100.0).cast("double")


def quarter_label(quarter: Column) -> Column:
    """PRJ-9: quarter number -> label."""
    # Quarter labels.
    return (F.when(quarter == 1, "Q1 Jan-Mar").when(quarter == 2, "Q2 Apr-Jun")
            .when(quarter == 3, "Q3 Jul-Sep").when(quarter == 4, "Q4 Oct-Dec"))


def tiered(value: Column, tiers: list[tuple[float, object]], default, inclusive: bool = False
           ) -> Column:
    """``when(value < t1, v1).when(value < t2, v2)...otherwise(default)``.

    ``inclusive`` switches the comparison to ``>=`` with tiers given high to
    low. A null value falls through to ``default``, as in the reference.
    """
    expr = None
    for bound, out in tiers:
        cond = value >= bound if inclusive else value < bound
        expr = F.when(cond, out) if expr is None else expr.when(cond, out)
    return expr.otherwise(default)


def yield_per_mile(itin_yield: Column, fare: Column, distance: Column) -> Column:
    """PRJ-6: the reported yield when usable, else fare / distance."""
    usable = itin_yield.isNotNull() & ~F.isnan(itin_yield) & (itin_yield > 0)
    return F.when(usable, itin_yield).otherwise(F.try_divide(fare, distance))
