"""History gap audit: classify every expected sensor-day, count per month.

Expected cells are (sensor, day) for every target sensor of a country over
that country's audited span.  Each cell is classified in a fixed order:

1. ``data_before_first`` — data landed on a day before the station's first day
2. ``with_data``         — data landed that day
3. ``pre_onboarding``    — no data, and no first day or the day precedes it
4. ``post_dormancy``     — no data, the day follows the station's last day
5. ``known_bad``         — no data, the sensor is on the known-bad list
6. ``upstream_no_data``  — everything else

Two plan shapes give the same monthly counts:

* per cell (:func:`gap_audit`, and :func:`gap_classify` for the cells
  themselves): the spine is generated per sensor with ``explode(sequence)``
  (narrow), joined to the distinct sensor-days with data on (sensor_id, day)
  (a shuffle join, both sides hash-partitioned on the same key), and the
  known-bad list is reduced to distinct ids before its left join;
* by masks (:func:`gap_audit_by_masks`, the default for the monthly report):
  the days of a sensor and month that have data are the bits of one integer,
  collected by ``bit_or`` (mergeable, combined before the shuffle, no
  distinct); the month's day ranges are masks as well, and every class is a
  bit count.  One row per sensor-month is joined, whatever the span.

Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake import constants as C

GAP_CLASSES = (
    "with_data",
    "pre_onboarding",
    "post_dormancy",
    "known_bad",
    "upstream_no_data",
    "data_before_first",
)


def calendar_spine(spans: DataFrame) -> DataFrame:
    """One row per (country, day), both span ends included."""
    return spans.select(
        "country_code",
        F.explode(F.sequence("span_start", "span_end", F.expr("INTERVAL 1 DAY"))).alias(
            "expected_day"
        ),
    )


def audited_sensors(
    sensors: DataFrame, locations: DataFrame, targets: Sequence[str] = C.TARGET_PARAMETERS
) -> DataFrame:
    """Target sensors with their station's country and activity range."""
    loc = locations.select(
        "location_id",
        "country_code",
        F.to_date("datetime_first_utc").alias("first_day"),
        F.to_date("datetime_last_utc").alias("last_day"),
    )
    return (
        sensors.where(F.col("parameter").isin(*targets))
        .select("sensor_id", "parameter", "location_id")
        .join(loc, "location_id")
        .drop("location_id")
    )


def expected_sensor_days(
    sensors: DataFrame, locations: DataFrame, spans: DataFrame,
    targets: Sequence[str] = C.TARGET_PARAMETERS,
) -> DataFrame:
    """Every (sensor, day) of the sensor's country span.

    The span table has one row per country, which the planner broadcasts by
    its size; the days are generated per sensor row, without a cross join.
    """
    s = audited_sensors(sensors, locations, targets)
    sp = spans.select("country_code", "span_start", "span_end")
    return s.join(sp, "country_code").select(
        "sensor_id",
        "parameter",
        "country_code",
        "first_day",
        "last_day",
        F.explode(F.sequence("span_start", "span_end", F.expr("INTERVAL 1 DAY"))).alias(
            "expected_day"
        ),
    )


def actual_sensor_days(measurements: DataFrame) -> DataFrame:
    """Distinct (sensor, UTC day) with at least one staged record, with or
    without a value."""
    return measurements.select(
        "sensor_id", F.to_date("period_start_utc").alias("measurement_day")
    ).distinct()


def gap_class() -> F.Column:
    has_data = F.col("has_data")
    first, last, day = F.col("first_day"), F.col("last_day"), F.col("expected_day")
    return (
        F.when(has_data & first.isNotNull() & (day < first), F.lit("data_before_first"))
        .when(has_data, F.lit("with_data"))
        .when(first.isNull() | (day < first), F.lit("pre_onboarding"))
        .when(last.isNotNull() & (day > last), F.lit("post_dormancy"))
        .when(F.col("is_known_bad"), F.lit("known_bad"))
        .otherwise(F.lit("upstream_no_data"))
    )


def gap_classify(expected: DataFrame, actual: DataFrame, known_bad: DataFrame) -> DataFrame:
    """Each expected cell with its class and month."""
    act = actual.select(
        F.col("sensor_id").alias("a_sensor_id"),
        F.col("measurement_day").alias("a_day"),
        F.lit(True).alias("has_data"),
    )
    bad = known_bad.select(F.col("sensor_id").alias("b_sensor_id")).distinct().withColumn(
        "is_known_bad", F.lit(True)
    )
    joined = expected.join(
        act,
        (expected["sensor_id"] == act["a_sensor_id"]) & (expected["expected_day"] == act["a_day"]),
        "left",
    ).join(bad, expected["sensor_id"] == bad["b_sensor_id"], "left")
    filled = joined.withColumn("has_data", F.coalesce("has_data", F.lit(False))).withColumn(
        "is_known_bad", F.coalesce("is_known_bad", F.lit(False))
    )
    return filled.select(
        "sensor_id",
        "country_code",
        "parameter",
        "expected_day",
        F.trunc("expected_day", "month").alias("audit_month"),
        gap_class().alias("gap_class"),
    )


def gap_audit_monthly(classified: DataFrame) -> DataFrame:
    """Counts per class as columns, total, and coverage % rounded to 0.1."""
    g = F.col("gap_class")
    counts = [F.count_if(g == name).alias(name) for name in GAP_CLASSES]
    agg = classified.groupBy("country_code", "parameter", "audit_month").agg(
        F.count(F.lit(1)).alias("expected_sensor_days"), *counts
    )
    coverage = F.round(F.col("with_data") / F.col("expected_sensor_days") * 100, 1)
    return agg.select(
        "country_code",
        "parameter",
        "audit_month",
        "expected_sensor_days",
        *GAP_CLASSES,
        coverage.alias("coverage_pct"),
    ).orderBy("country_code", "parameter", "audit_month")


def gap_audit(
    sensors: DataFrame,
    locations: DataFrame,
    measurements: DataFrame,
    known_bad: DataFrame,
    spans: DataFrame,
) -> DataFrame:
    expected = expected_sensor_days(sensors, locations, spans)
    classified = gap_classify(expected, actual_sensor_days(measurements), known_bad)
    return gap_audit_monthly(classified)


# --- monthly counts without enumerating cells -----------------------------------


def sensor_month_masks(measurements: DataFrame) -> DataFrame:
    """Per country, sensor and month the days with a record, as bits of ``day_mask`` (bit 0 is the 1st).

    A record counts with or without a value.  Everything the audit asks of the
    measurements, the countries' spans included, follows from these rows.
    """
    day = F.to_date("period_start_utc")
    return measurements.where(day.isNotNull()).groupBy(
        "country_code", "sensor_id", F.trunc(day, "month").alias("audit_month")
    ).agg(F.bit_or(F.expr("shiftleft(1, day(to_date(period_start_utc)) - 1)")).alias("day_mask"))


def _lowest_bit(mask):
    return F.bit_count(F.expr(f"({mask} & -{mask}) - 1")).cast("int")


def _highest_bit(mask):
    return F.floor(F.log2(F.col(mask).cast("double"))).cast("int")


def mask_spans(masks: DataFrame) -> DataFrame:
    """First and last day with a record per country."""
    return masks.groupBy("country_code").agg(
        F.min(F.date_add("audit_month", _lowest_bit("day_mask"))).alias("span_start"),
        F.max(F.date_add("audit_month", _highest_bit("day_mask"))).alias("span_end"),
    )


def _days_mask(lo, hi, month):
    """Bits of the days of ``month`` in ``[lo, hi]``; 0 when there is none."""
    a = F.greatest(F.datediff(lo, month), F.lit(0))
    b = F.least(F.datediff(hi, month), F.lit(30))
    one = F.lit(1).cast("long")
    upto = lambda n: F.call_function("shiftleft", one, n) - 1
    return F.when(b >= a, upto(b + 1) - upto(a)).otherwise(F.lit(0).cast("long"))


def gap_audit_by_masks(
    sensors: DataFrame,
    locations: DataFrame,
    masks: DataFrame,
    known_bad: DataFrame,
    spans: DataFrame,
    targets: Sequence[str] = C.TARGET_PARAMETERS,
) -> DataFrame:
    """The monthly audit from ``masks`` (as of :func:`sensor_month_masks`) instead of from cells.

    A month of one sensor splits into the days before its first day (all of
    them when there is none), after its last day, and between.  Days outside the
    span count for nothing.  This equals classifying every (sensor, day) cell
    in the fixed class order.
    """
    bad = known_bad.select("sensor_id").distinct().withColumn("is_known_bad", F.lit(True))
    months = (
        audited_sensors(sensors, locations, targets)
        .join(spans.select("country_code", "span_start", "span_end"), "country_code")
        .join(bad, "sensor_id", "left")
        .withColumn(
            "audit_month",
            F.explode(F.sequence(F.trunc("span_start", "month"), F.trunc("span_end", "month"), F.expr("INTERVAL 1 MONTH"))),
        )
    )
    # A sensor may have records under more than one country's path.
    seen = masks.groupBy("sensor_id", "audit_month").agg(F.bit_or("day_mask").cast("long").alias("seen"))
    joined = months.join(seen, ["sensor_id", "audit_month"], "left")

    first, last, month = F.col("first_day"), F.col("last_day"), F.col("audit_month")
    a, b = F.greatest("span_start", "audit_month"), F.least(F.col("span_end"), F.last_day(month))
    days = _days_mask(a, b, month)
    none = F.lit(0).cast("long")
    before = F.when(first.isNull(), none).otherwise(_days_mask(a, F.least(b, F.date_sub(first, 1)), month))
    after = F.when(last.isNull(), none).otherwise(_days_mask(F.greatest(a, F.date_add(last, 1)), b, month))
    marked = joined.select(
        "country_code", "parameter", "audit_month",
        first.isNull().alias("unknown"), F.coalesce("is_known_bad", F.lit(False)).alias("listed"),
        days.alias("days"), before.alias("before"), after.alias("after"),
        F.coalesce("seen", none).bitwiseAND(days).alias("data"),
    )
    count = lambda text: F.expr(f"bit_count({text})")
    quiet = "days & ~data & ~before"  # days without data, from the first day on
    rest = F.when(F.col("unknown"), F.lit(0)).otherwise(count(f"{quiet} & ~after"))
    classes = {
        "with_data": count("data & ~before"),
        "pre_onboarding": F.when(F.col("unknown"), count("days & ~data")).otherwise(count("before & ~data")),
        "post_dormancy": F.when(F.col("unknown"), F.lit(0)).otherwise(count(f"{quiet} & after")),
        "known_bad": F.when(F.col("listed"), rest).otherwise(F.lit(0)),
        "upstream_no_data": F.when(F.col("listed"), F.lit(0)).otherwise(rest),
        "data_before_first": count("data & before"),
    }
    agg = marked.groupBy("country_code", "parameter", "audit_month").agg(
        F.sum(count("days")).cast("bigint").alias("expected_sensor_days"),
        *[F.sum(expr).cast("bigint").alias(name) for name, expr in classes.items()],
    )
    coverage = F.round(F.col("with_data") / F.col("expected_sensor_days") * 100, 1)
    return agg.select(
        "country_code", "parameter", "audit_month", "expected_sensor_days", *GAP_CLASSES,
        coverage.alias("coverage_pct"),
    ).orderBy("country_code", "parameter", "audit_month")


def gap_audit_by_ranges(
    sensors: DataFrame,
    locations: DataFrame,
    measurements: DataFrame,
    known_bad: DataFrame,
    spans: DataFrame,
    targets: Sequence[str] = C.TARGET_PARAMETERS,
) -> DataFrame:
    """:func:`gap_audit_by_masks` over staged measurements."""
    with_country = measurements if "country_code" in measurements.columns else measurements.withColumn("country_code", F.lit(None).cast("string"))
    return gap_audit_by_masks(sensors, locations, sensor_month_masks(with_country), known_bad, spans, targets)
