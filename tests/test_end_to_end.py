"""Reference-layout raw zone → landing → gated build → incremental rebuild → audit."""

import json
import os

import pytest
from helpers import location, reading

from stationlake.operators import audit as A
from stationlake.operators import runs as R
from stationlake.plans import incremental as IN
from stationlake.plans.build import BuildFailed, build_all, register_views
from stationlake.plans.checks import suite
from stationlake.sources import pages as P
from stationlake.sources.seeds import read_known_bad, read_thresholds

CHECKS = suite(countries=("AE", "PK"), parameters=("pm25", "pm10", "no2"))


def _put(zone, cc, day, leaf, records):
    d = os.path.join(zone, cc, day)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, f"{leaf}.json"), "w") as f:
        f.write(json.dumps({"results": records}) + "\n")


def _zone(tmp_dir):
    zone = os.path.join(tmp_dir, "zone", "raw", "airq")
    loc = location(1, "AE", [(11, "pm25"), (12, "no2")], first="2026-07-01T00:00:00Z", last="2026-07-12T23:00:00Z")
    _put(zone, "AE", "2026-07-12", "locations", [loc])
    _put(zone, "AE", "2026-07-12", "11", [reading(20.0, "2026-07-12 01:00:00"), reading(10.0, "2026-07-12 02:00:00")])
    _put(zone, "AE", "2026-07-12", "12", [reading(30.0, "2026-07-12 01:00:00", parameter="no2")])
    bad = os.path.join(tmp_dir, "bad.csv")
    with open(bad, "w") as f:
        f.write("sensor_id,country_code,first_seen_failing,last_verified_failing,note\n12,AE,2026-07-01,2026-07-02,x\n")
    return zone, bad


def test_end_to_end(spark, tmp_dir):
    zone, bad_csv = _zone(tmp_dir)
    raw_path = os.path.join(tmp_dir, "raw_table")
    P.ensure_raw_table(spark, raw_path)
    P.append_batch(P.land_batch(P.scan_pages(spark, [os.path.join(zone, "AE", "2026-07-12", "*")]), "2026-07-13 02:05:00"), raw_path)
    raw = P.read_raw(spark, raw_path)
    known_bad = read_known_bad(spark, bad_csv)
    result = build_all(spark, raw, read_thresholds(spark), known_bad, os.path.join(tmp_dir, "models"), suite=CHECKS, run_id="r1")
    cc = {r["parameter"]: r for r in result.tables["mart_country_compare"].collect()}
    assert cc["pm25"]["country_daily_avg"] == 15.0 and cc["pm25"]["locations_exceeding"] == 0
    assert cc["no2"]["locations_exceeding"] == 1 and cc["no2"]["exceedance_rate"] == 100.0
    register_views(result)
    sql = spark.sql(
        "SELECT parameter, locations_exceeding, locations_comparable FROM mart_country_compare "
        "WHERE country_code = 'AE' ORDER BY parameter"
    ).collect()
    assert [tuple(r) for r in sql] == [("no2", 1, 1), ("pm25", 0, 1)]
    assert spark.sql("SELECT count(*) FROM stg_measurements").first()[0] == 3
    report = result.report.collect()
    assert len(report) == len(CHECKS) and {r["run_id"] for r in report} == {"r1"}
    assert all(r["status"] == "pass" for r in report)

    # a later load corrects a reading; only its day is rebuilt
    _put(zone, "AE", "2026-07-13", "11", [reading(40.0, "2026-07-12 02:00:00")])
    P.append_batch(P.land_batch(P.scan_pages(spark, [os.path.join(zone, "AE", "2026-07-13", "*")]), "2026-07-14 02:05:00"), raw_path)
    raw = P.read_raw(spark, raw_path)
    days_path = result.paths["int_sensor_days"]
    IN.update_sensor_days(spark, raw, "2026-07-14 00:00:00", days_path)
    stored = IN.read_daily(spark, days_path, result.tables["stg_sensors"], result.tables["stg_locations"])
    daily = {r["parameter"]: r["daily_avg"] for r in stored.collect()}
    assert daily == {"pm25": 30.0, "no2": 30.0}
    assert R.records_in_latest_batch(raw, "%/raw/airq/AE/2026-07-13/%").first()["records"] == 1

    spans = spark.createDataFrame([("AE",)], "country_code STRING").selectExpr(
        "country_code", "DATE'2026-07-11' AS span_start", "DATE'2026-07-13' AS span_end")
    audit = {r["parameter"]: r for r in A.gap_audit_by_ranges(
        result.tables["stg_sensors"], result.tables["stg_locations"], result.tables["stg_measurements"], known_bad, spans).collect()}
    assert (audit["pm25"]["with_data"], audit["pm25"]["upstream_no_data"], audit["pm25"]["post_dormancy"]) == (1, 1, 1)
    assert (audit["no2"]["with_data"], audit["no2"]["known_bad"], audit["no2"]["post_dormancy"]) == (1, 1, 1)


def test_the_build_parses_measurement_pages_once(spark, tmp_dir):
    zone, bad_csv = _zone(tmp_dir)
    raw_path = os.path.join(tmp_dir, "raw_table")
    P.append_batch(P.land_batch(P.scan_pages(spark, [os.path.join(zone, "AE", "2026-07-12", "*")]), "2026-07-13 02:05:00"), raw_path)
    result = build_all(spark, P.read_raw(spark, raw_path), read_thresholds(spark), read_known_bad(spark, bad_csv),
                       os.path.join(tmp_dir, "models"), suite=CHECKS)
    for table in result.tables.values():
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "from_json" not in plan, plan


def test_empty_input_builds_empty_tables(spark, tmp_dir):
    raw_path = os.path.join(tmp_dir, "raw_table")
    raw = P.ensure_raw_table(spark, raw_path)
    _, bad_csv = _zone(tmp_dir)
    result = build_all(spark, raw, read_thresholds(spark), read_known_bad(spark, bad_csv), os.path.join(tmp_dir, "models"), suite=CHECKS)
    for name in ("stg_measurements", "int_daily", "mart_country_compare", "mart_annual_compare"):
        assert result.tables[name].count() == 0


def test_failed_error_check_stops_the_build(spark, tmp_dir):
    zone, bad_csv = _zone(tmp_dir)
    raw_path = os.path.join(tmp_dir, "raw_table")
    P.append_batch(P.land_batch(P.scan_pages(spark, [os.path.join(zone, "AE", "2026-07-12", "*")]), "2026-07-13 02:05:00"), raw_path)
    strict = suite(countries=("PK",), parameters=("pm25", "pm10", "no2"))  # AE is not accepted
    with pytest.raises(BuildFailed, match="staging checks failed"):
        build_all(spark, P.read_raw(spark, raw_path), read_thresholds(spark), read_known_bad(spark, bad_csv),
                  os.path.join(tmp_dir, "models"), suite=strict)
    assert not os.path.exists(os.path.join(tmp_dir, "models", "int_daily"))
