"""Marts: country-day comparison and annual comparison against guidelines.

Both read the station-day table.  Thresholds are matched on pollutant *and*
unit; a row without a matching threshold keeps a null flag and leaves only the
rate's denominator, never the table.  Means are means of station-day means.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.functions.columns import rate_pct


def thresholds_for(thresholds: DataFrame, period: str, value_name: str) -> DataFrame:
    """The rows of one averaging period, keyed (pollutant, unit).

    The planner broadcasts the caller's table by its size in bytes.
    """
    return thresholds.where(F.col("averaging_period") == period).select(
        F.col("pollutant").alias("__t_pollutant"),
        F.col("unit").alias("__t_unit"),
        F.col("threshold_value").alias(value_name),
    )


def threshold_join(df: DataFrame, thresholds: DataFrame, period: str, value_name: str) -> DataFrame:
    """Left join on (parameter = pollutant, unit = unit); unmatched keeps null."""
    t = thresholds_for(thresholds, period, value_name)
    cond = (df["parameter"] == t["__t_pollutant"]) & (df["unit"] == t["__t_unit"])
    return df.join(t, cond, "left").drop("__t_pollutant", "__t_unit")


def exceeds(value: Column | str, threshold: Column | str) -> Column:
    """Strict ``>``: null when either side is null, false on equality."""
    v = F.col(value) if isinstance(value, str) else value
    t = F.col(threshold) if isinstance(threshold, str) else threshold
    return v > t


def threshold_flag_24h(daily: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Station-days with their 24h threshold and the three-valued flag."""
    flagged = threshold_join(daily, thresholds, "24h", "threshold_24h")
    return flagged.withColumn("exceeded_24h", exceeds("daily_avg", "threshold_24h"))


COUNTRY_DAY_KEYS = ["country_code", "parameter", "unit", "measurement_date"]


def country_day(daily: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Country-day roll-up with explicit numerator and denominator."""
    flagged = threshold_flag_24h(daily, thresholds)
    flag = F.col("exceeded_24h")
    return flagged.groupBy(*COUNTRY_DAY_KEYS).agg(
        # constant within a group (one threshold per parameter and unit)
        F.max("threshold_24h").alias("threshold_24h"),
        F.avg("daily_avg").alias("country_daily_avg"),
        F.count_distinct("location_id").alias("locations_with_data"),
        F.count_if(flag).alias("locations_exceeding"),
        F.count_if(flag.isNotNull()).alias("locations_comparable"),
        F.sum("reading_count").alias("reading_count"),
        F.avg("hours_covered").alias("avg_hours_covered"),
        F.count_if(F.col("is_reference_monitor")).alias("reference_monitor_locations"),
    )


def rolling_range_avg(
    df: DataFrame,
    value: str,
    partition_by: list[str],
    day: str,
    days: int = 7,
    name: str = "rolling_7d_avg",
) -> DataFrame:
    """Mean of ``value`` over the last ``days`` *calendar* days, this day included.

    A range frame on the day number, not a row frame: a missing day narrows
    the window instead of widening it, and every row of the same day (for
    example two units) is a peer inside the frame.  The input is a
    country-day table, so each window partition holds at most one row per
    day and unit.
    """
    w = (
        Window.partitionBy(*partition_by)
        .orderBy(F.unix_date(F.col(day)))
        .rangeBetween(-(days - 1), Window.currentRow)
    )
    return df.withColumn(name, F.avg(value).over(w))


COUNTRY_COMPARE_COLUMNS = [
    "country_code",
    "parameter",
    "unit",
    "measurement_date",
    "threshold_24h",
    "country_daily_avg",
    "locations_with_data",
    "locations_exceeding",
    "locations_comparable",
    "reading_count",
    "avg_hours_covered",
    "reference_monitor_locations",
    "exceedance_rate",
    "rolling_7d_avg",
]


def country_compare(daily: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Grain (country, parameter, unit, day): rate with denominator + 7-day mean.

    The rolling window is partitioned by (country, parameter) only, so two
    units of one parameter share a frame, as specified.
    """
    by_day = country_day(daily, thresholds).withColumn(
        "exceedance_rate", rate_pct("locations_exceeding", "locations_comparable")
    )
    rolled = rolling_range_avg(
        by_day, "country_daily_avg", ["country_code", "parameter"], "measurement_date"
    )
    return rolled.select(*COUNTRY_COMPARE_COLUMNS)


ANNUAL_COLUMNS = [
    "country_code",
    "parameter",
    "unit",
    "measurement_year",
    "annual_mean",
    "days_with_data",
    "locations_with_data",
    "reading_count",
    "threshold_annual",
    "exceeds_annual",
]


#: Days of a year that one integer holds, and how many integers a year takes.
MASK_DAYS, YEAR_MASKS = 62, 6


def _year_masks(day: str) -> list[Column]:
    """The days seen in a year as bits of YEAR_MASKS integers: mergeable, so that counting days needs no distinct."""
    n = f"(dayofyear({day}) - 1)"
    bit = f"shiftleft(1L, {n} % {MASK_DAYS})"
    return [F.bit_or(F.expr(f"CASE WHEN {n} div {MASK_DAYS} = {i} THEN {bit} END")).alias(f"days_{i}") for i in range(YEAR_MASKS)]


def annual_rollup(daily: DataFrame) -> DataFrame:
    """Country-years of station-days, by way of station-years.

    A station-year is one row with its sums and the days it saw, so a
    country-year counts rows for its stations and bits for its days: no
    distinct aggregate, and the station-days are combined before any shuffle.
    """
    keys = ["country_code", "parameter", "unit", "measurement_year"]
    stations = daily.groupBy(
        "country_code", "parameter", "unit", F.year("measurement_date").cast("bigint").alias("measurement_year"), "location_id"
    ).agg(
        F.sum("daily_avg").alias("mean_sum"),
        F.count("daily_avg").alias("mean_count"),
        F.sum("reading_count").alias("reading_count"),
        *_year_masks("measurement_date"),
    )
    days = sum((F.coalesce(F.bit_count(F.bit_or(f"days_{i}")), F.lit(0)) for i in range(YEAR_MASKS)), F.lit(0).cast("bigint"))
    return stations.groupBy(*keys).agg(
        F.try_divide(F.sum("mean_sum"), F.sum("mean_count")).alias("annual_mean"),
        days.alias("days_with_data"),
        F.count("location_id").alias("locations_with_data"),
        F.sum("reading_count").alias("reading_count"),
    )


def annual_compare(daily: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Grain (country, parameter, unit, year) against the annual guideline only."""
    joined = threshold_join(annual_rollup(daily), thresholds, "annual", "threshold_annual")
    return joined.withColumn(
        "exceeds_annual", exceeds("annual_mean", "threshold_annual")
    ).select(*ANNUAL_COLUMNS)

