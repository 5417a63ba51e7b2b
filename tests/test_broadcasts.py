"""Tables that grow with the facts never go through the driver, whatever their files' size says."""

from conftest import SF_SMALL
from helpers import page, raw_df, raw_row, reading, uri

from stationlake.operators import daily as D
from stationlake.plans import backfill as B
from stationlake.sources import driver_tables as T


def broadcast_parts(df) -> list[str]:
    """The lines of ``df``'s plan below each broadcast."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = lambda line: next((i for i, c in enumerate(line) if c.isalnum()), 0)
    found, at = [], None
    for line in lines:
        if at is not None and depth(line) > at:
            found.append(line)
        else:
            at = depth(line) if "BroadcastExchange" in line else None
    return found


def test_readings_are_not_broadcast_however_small_their_files(spark):
    for df in (T.readings(spark, SF_SMALL), T.station_activity(spark, SF_SMALL), T.raw_pages(spark, SF_SMALL)):
        below = broadcast_parts(df)
        assert any("region.parquet" in line for line in below)  # broadcasts are seen
        assert not any("Join" in line and "user_id" in line for line in below)
    assert not any("events.parquet" in line for line in broadcast_parts(T.readings(spark, SF_SMALL)))


def test_activity_is_that_of_all_readings(spark):
    r = T.readings(spark, SF_SMALL).join(T.sensor_geography(spark, SF_SMALL).drop("country_code"), "sensor_id")
    seen = {x[0]: (x[1], x[2]) for x in r.groupBy("location_id").agg({"reading_ts": "min"}).join(
        r.groupBy("location_id").agg({"reading_ts": "max"}), "location_id").collect()}
    day = T.dt.timedelta(days=1)
    for a in T.station_activity(spark, SF_SMALL).where("first_ts IS NOT NULL").collect():
        first, last = seen[a["location_id"]]
        assert (a["first_ts"], a["last_ts"]) == (first + day, last - day)


def test_stored_sensor_days_are_not_broadcast_in_the_roll_up(spark, tmp_dir):
    days = "1L AS sensor_id, 'pm25' AS parameter, 'u' AS unit, DATE'2026-07-01' AS measurement_date, 2.0D AS value_sum, 2.0D AS value_min, 2.0D AS value_max, 1L AS reading_count, 3 AS hour_mask"
    spark.range(1).selectExpr(*days.split(", ")).write.parquet(f"{tmp_dir}/days")
    sensors = spark.range(10_000_000).where("id < 5").selectExpr("id AS sensor_id", "id % 2 AS location_id")  # large by the planner's guess
    locations = spark.range(10_000_000).where("id < 2").selectExpr("id AS location_id", "'NO' AS country_code", "true AS is_reference_monitor")
    out = D.roll_up(spark.read.parquet(f"{tmp_dir}/days"), sensors, locations)
    assert not any("value_sum" in line for line in broadcast_parts(out))
    assert [(r["location_id"], r["daily_avg"], r["hours_covered"]) for r in out.collect()] == [(1, 2.0, 2)]


CHUNK_ROW = "'NO' AS country_code, DATE'2026-07-01' AS chunk_start, DATE'2026-07-08' AS chunk_end"


def test_targets_and_fetch_log_are_not_broadcast(spark, tmp_dir):
    spark.range(3).selectExpr("'NO' AS country_code", "id AS sensor_id").write.parquet(f"{tmp_dir}/targets")
    log = spark.range(5).selectExpr(*CHUNK_ROW.split(", "), "id AS sensor_id", "'ok' AS status", "1L AS measurements")
    todo = spark.range(1).selectExpr(*CHUNK_ROW.split(", "))
    mine = B.open_fetches(log, todo, spark.read.parquet(f"{tmp_dir}/targets"))
    assert not any("sensor_id" in line for line in broadcast_parts(mine))
    assert sorted(r["sensor_id"] for r in mine.collect()) == [0, 1, 2]


def test_only_pages_of_marked_batches_are_parsed(spark):
    stamps = ("2026-07-09 02:00:00", "2026-07-09 05:00:00")
    rows = [raw_row(page(reading(1.0, "2026-07-01 00:00:00")), s, uri("NO", f"backfill/2026-07-0{d}_2026-07-08", 5)) for d in (1, 2) for s in stamps]
    rows.append(raw_row(page(), stamps[0], "lake://zone/elsewhere"))
    marked = spark.createDataFrame([("NO", "backfill/2026-07-01_2026-07-08", stamps[0]), ("NO", "backfill/2026-07-03_2026-07-08", stamps[0])],
                                   "country_code STRING, chunk_label STRING, s STRING").selectExpr("country_code", "chunk_label", "to_timestamp(s) AS stamp")
    found = B.landed_at(raw_df(spark, rows), marked)
    assert sorted(r["landed_records"] for r in found.collect()) == [0, 1]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")  # below the counts


def test_a_run_derives_its_targets_once(spark, tmp_dir, monkeypatch):
    names, stored = [], B._stored
    monkeypatch.setattr(B, "_stored", lambda df, name: names.append(name) or stored(df, name))
    chunks = spark.range(1).selectExpr(*CHUNK_ROW.split(", "), "'backfill/2026-07-01_2026-07-08' AS chunk_label")
    targets = spark.range(3).selectExpr("'NO' AS country_code", "id AS sensor_id", "'pm25' AS parameter")
    log = spark.range(2).selectExpr(*CHUNK_ROW.split(", "), "id AS sensor_id", "'ok' AS status", "1L AS measurements")
    body = page(reading(1.0, "2026-07-01 00:00:00"))
    pages = spark.range(3).selectExpr(*CHUNK_ROW.split(", "), "id AS sensor_id", f"'{body}' AS body")
    inventory = spark.createDataFrame([], "country_code STRING, body STRING")
    done = B.run(spark, chunks, targets, log, pages, inventory, B.RunTables.under(f"{tmp_dir}/run"))
    assert [(r["sensors_with_data"], r["sensors_empty"], r["measurements"]) for r in done.collect()] == [(2, 1, 2)]
    assert names.count("backfill-targets") == 1
