"""Plan-shape regressions: the properties PLANS.md relies on."""

from helpers import location, page, raw_df, raw_row, reading, uri
from pyspark.sql import functions as F

from stationlake.operators import audit as A
from stationlake.operators import daily as D
from stationlake.operators import quality as Q
from stationlake.operators import runs as R
from stationlake.operators import staging as S
from stationlake.sources import pages as P


def _raw(spark):
    rows = [raw_row(page(location(1, "AE", [(11, "pm25")])), "2026-07-01 00:00:00", uri("AE", "2026-07-01", "locations"))]
    rows += [raw_row(page(reading(float(h), f"2026-07-01 {h:02d}:00:00")), "2026-07-02 02:05:00", uri("AE", "2026-07-01", 11))
             for h in range(5)]
    return raw_df(spark, rows)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_pages_and_records_are_parsed_once(spark):
    plan = _plan(S.stage_measurements(_raw(spark)))
    lines = [ln for ln in plan.splitlines() if "from_json" in ln]
    # the page in the generator, each record in one projection
    assert sum("Generate" in ln for ln in lines) == 1 and len(lines) == 2, plan


def test_latest_wins_limits_before_and_after_the_shuffle(spark):
    df = S.stage_measurements(_raw(spark))
    df.collect()
    plan = _plan(df)
    # a partial top-1 per key before the exchange and a final one after it
    assert "row_number(), 1, Partial" in plan and "row_number(), 1, Final" in plan, plan


def test_station_days_need_no_expand(spark):
    raw = _raw(spark)
    daily = D.daily_station_agg(S.stage_measurements(raw), S.stage_sensors(raw), S.stage_locations(raw))
    daily.collect()
    plan = _plan(daily)
    assert "Expand" not in plan, plan


def test_country_years_need_no_expand(spark):
    from stationlake.operators import marts as M

    raw = _raw(spark)
    daily = D.daily_station_agg(S.stage_measurements(raw), S.stage_sensors(raw), S.stage_locations(raw))
    yearly = M.annual_rollup(daily)
    row = yearly.first()
    assert (row["days_with_data"], row["locations_with_data"], row["reading_count"]) == (1, 1, 5)
    assert "Expand" not in _plan(yearly)


def test_days_at_both_ends_of_a_year_and_of_a_mask(spark):
    from stationlake.operators import marts as M

    days = ["2032-01-01", "2032-03-02", "2032-03-03", "2032-12-31", "2031-12-31"]
    daily = spark.createDataFrame(
        [("NO", "pm25", "u", d, place, 1.0, 1) for d in days for place in (1, 2)],
        "country_code STRING, parameter STRING, unit STRING, measurement_date STRING, location_id BIGINT, daily_avg DOUBLE, reading_count BIGINT",
    ).withColumn("measurement_date", F.to_date("measurement_date"))
    got = {r["measurement_year"]: (r["days_with_data"], r["locations_with_data"]) for r in M.annual_rollup(daily).collect()}
    assert got == {2032: (4, 2), 2031: (1, 2)}


def test_the_monthly_audit_reads_measurement_pages_once_and_counts_nothing_distinct(spark):
    masks = A.sensor_month_masks(S.parse_measurements(S.measurement_records(_raw(spark))))
    plan = _plan(masks)
    assert plan.count("posexplode") == 1 and plan.count("Exchange") == 1 and "Expand" not in plan, plan


def test_masks_hold_the_first_and_the_last_day_of_a_month(spark):
    days = ["2032-02-01", "2032-02-29", "2032-03-31"]
    records = spark.createDataFrame([("NO", 1, d + " 05:00:00") for d in days], "country_code STRING, sensor_id BIGINT, t STRING")
    masks = A.sensor_month_masks(records.withColumn("period_start_utc", F.to_timestamp("t")))
    assert {r["audit_month"].month: bin(r["day_mask"] & 0xFFFFFFFF).count("1") for r in masks.collect()} == {2: 2, 3: 1}
    span = A.mask_spans(masks).first()
    assert (str(span["span_start"]), str(span["span_end"])) == ("2032-02-01", "2032-03-31")


def test_fresh_partitions_and_the_newest_batch_are_read_alone(spark, tmp_dir):
    P.append_batch(_raw(spark), f"{tmp_dir}/raw")
    late = [raw_row(page(reading(1.0, "2026-07-01 05:00:00")), "2026-07-09 02:05:00", uri("SE", "2026-07-01", 5))]
    P.append_batch(raw_df(spark, late), f"{tmp_dir}/raw")
    raw = P.read_raw(spark, f"{tmp_dir}/raw")
    keyed = raw.withColumn("country_code", F.regexp_extract("source_uri", "/raw/airq/([A-Z]{2})/", 1))
    expected = spark.createDataFrame([("SE",)], "country_code STRING")
    fresh = Q.partition_freshness(keyed, "ingested_at", "ingest_date", "2026-07-09 06:00:00", ["country_code"], expected)
    assert [r["freshness"] for r in fresh.collect()] == ["pass"]
    assert "PartitionFilters: [isnotnull(ingest_date" in _plan(fresh)
    every = expected.unionByName(spark.createDataFrame([("AE",), ("ZZ",)], "country_code STRING"))
    aged = Q.partition_freshness(keyed, "ingested_at", "ingest_date", "2026-07-09 06:00:00", ["country_code"], every)
    got = {r["country_code"]: (r["freshness"], str(r["latest_loaded_at"])) for r in aged.collect()}
    assert got == {"SE": ("pass", "2026-07-09 02:05:00"), "AE": ("error", "2026-07-02 02:05:00"), "ZZ": ("error", "None")}
    newest = R.records_in_latest_batch(raw, "%/raw/airq/%/2026-07-01/%")
    assert newest.first()["records"] == 1 and "PartitionFilters: [isnotnull(ingest_date" in _plan(newest)
    assert R.records_in_latest_batch(raw, "%/nowhere/%").first()["records"] == 0
