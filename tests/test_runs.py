"""Fetch summaries, the failure gate, reconciliation and resumable manifests."""

import datetime as dt

import pytest
from helpers import page, raw_df, raw_row, reading, uri
from pyspark.sql import functions as F

from stationlake.operators import runs as R
from stationlake.schemas import FETCH_LOG_DDL


def log(spark, statuses):
    rows = []
    for i, (status, n) in enumerate(statuses):
        rows.append(("PK", i, "pm25", status, n, None, None))
    return spark.createDataFrame(rows, FETCH_LOG_DDL)


@pytest.mark.parametrize("fetched,failed,passes", [(25, 4, True), (25, 5, True), (25, 6, False), (1, 1, False), (3, 0, True)])
def test_the_gate_around_its_limit(spark, fetched, failed, passes):
    ok = (fetched - failed) // 2
    fl = log(spark, [("failed", 0)] * failed + [("ok", 4)] * ok + [("empty", 9)] * (fetched - failed - ok))
    s = R.failure_gate(R.fetch_summary(fl)).first()
    assert (s["sensors_fetched"], s["sensors_ok"], s["sensors_failed"], s["measurements"]) == (fetched, ok, failed, 4 * ok)
    assert s["passes"] is passes
    assert [r["sensor_id"] for r in R.failed_sensors(fl).collect()] == list(range(failed))


def test_enforce_raises_on_false_and_on_null(spark):
    rows = spark.createDataFrame([(1, True), (2, True)], "i INT, fine BOOLEAN")
    assert R.enforce(rows, "fine", "not fine").count() == 2
    for bad in (False, None):
        worse = rows.unionAll(spark.createDataFrame([(3, bad)], "i INT, fine BOOLEAN"))
        with pytest.raises(Exception, match="not fine"):
            R.enforce(worse, "fine", "not fine").count()


def test_empty_log_rate_is_zero(spark):
    s = spark.createDataFrame([("PK", 0, 0)], "country_code STRING, sensors_failed BIGINT, sensors_fetched BIGINT")
    assert R.failure_gate(s).first()["failure_rate"] == 0.0


def test_latest_batch_and_reconcile(spark):
    body = page(reading(1.0, "2026-07-14 01:00:00"), reading(2.0, "2026-07-14 02:00:00"))
    rows = [
        raw_row(body, "2026-07-15 02:05:00", uri("PK", "2026-07-14", 1)),
        raw_row(body, "2026-07-15 09:00:00", uri("PK", "2026-07-14", 1)),  # rerun
        raw_row(page(reading(3.0, "2026-07-14 03:00:00")), "2026-07-15 09:00:00", uri("PK", "2026-07-14", 2)),
        raw_row('{"results": [{"id": 1}]}', "2026-07-15 09:00:00", uri("PK", "2026-07-14", "locations")),
    ]
    landed = R.latest_batch_records(raw_df(spark, rows)).first()
    assert landed["segment"] == "2026-07-14" and landed["landed_records"] == 3 and landed["batches"] == 2
    summary = spark.createDataFrame([("PK", "2026-07-14", 3), ("PK", "2026-07-15", 4)],
                                    "country_code STRING, segment STRING, measurements BIGINT")
    rec = {r["segment"]: r for r in R.reconcile_counts(summary, R.latest_batch_records(raw_df(spark, rows))).collect()}
    assert rec["2026-07-14"]["matches"] is True
    assert rec["2026-07-15"]["landed_total"] == 0 and rec["2026-07-15"]["matches"] is False


def test_inventory_stamp_can_be_the_latest_batch(spark):
    rows = [
        raw_row(page(reading(1.0, "2026-07-14 01:00:00")), "2026-07-15 02:05:00", uri("PK", "2026-07-14", 1)),
        raw_row('{"results": [{"id": 1}]}', "2026-07-15 03:00:00", uri("PK", "2026-07-14", "locations")),
    ]
    assert R.latest_batch_records(raw_df(spark, rows)).first()["landed_records"] == 0


def test_manifest_resume(spark, tmp_dir):
    chunks = spark.createDataFrame(
        [("PK", dt.date(2026, 1, d1), dt.date(2026, 1, d2)) for d1, d2 in ((1, 3), (3, 5), (5, 6))],
        "country_code STRING, chunk_start DATE, chunk_end DATE",
    )
    path = f"{tmp_dir}/manifest"
    assert R.windows_todo(chunks, R.read_manifest(spark, path)).count() == 3
    outcomes = chunks.withColumns({
        "measurements": F.lit(10), "sensors_ok": F.lit(2), "sensors_empty": F.lit(0),
        "sensors_failed": F.lit(0), "passes": F.col("chunk_start") < F.lit(dt.date(2026, 1, 5)),
        "matches": F.lit(True),
    })
    R.append_manifest(R.manifest_records(outcomes, "2026-01-07 00:00:00"), path)
    R.append_manifest(R.manifest_records(outcomes, "2026-01-07 00:00:00"), path)  # repeated append
    todo = R.windows_todo(chunks, R.read_manifest(spark, path)).collect()
    assert [(r["chunk_start"].day, r["chunk_end"].day) for r in todo] == [(5, 6)]
    all_done = outcomes.withColumn("passes", F.lit(True))
    R.append_manifest(R.manifest_records(all_done, "2026-01-08 00:00:00"), path)
    assert R.windows_todo(chunks, R.read_manifest(spark, path)).count() == 0


def test_skip_lists(spark):
    sensors = spark.createDataFrame([(1,), (2,), (3,)], "sensor_id BIGINT")
    skip = spark.createDataFrame([(2,), (2,), (9,)], "sensor_id BIGINT")
    assert sorted(r[0] for r in R.skip_known_bad(sensors, skip).collect()) == [1, 3]
    assert R.skip_overlap(sensors, skip).count() == 1


def test_records_in_latest_batch_like_and_prefix(spark):
    rows = [
        raw_row(page(reading(1.0, "2026-01-01 01:00:00")), "2026-03-03 02:00:00",
                "lake://zone/raw/airq/PK/backfill/2026-01-01_2026-03-02/7.json"),
        raw_row(page(reading(1.0, "2026-01-01 01:00:00")), "2026-03-03 05:00:00",
                "lake://zone/raw/airq/PK/backfillX2026-01-01_2026-03-02/7.json"),
    ]
    raw = raw_df(spark, rows)
    like = R.records_in_latest_batch(raw, "lake://zone/raw/airq/PK/backfill/2026-01-01_2026-03-02/%").first()
    assert like["records"] == 1
    assert like["latest_batch"].hour == 2
    # `_` in a LIKE pattern matches any character, so this pattern also
    # matches the `backfillX…` object and picks its later batch
    loose = R.records_in_latest_batch(raw, "lake://zone/raw/airq/PK/backfill_2026-01-01_2026-03-02/%").first()
    assert loose["latest_batch"].hour == 5
    prefix = R.records_in_latest_batch(
        raw, "lake://zone/raw/airq/PK/backfill/2026-01-01_2026-03-02/", mode="prefix"
    ).first()
    assert prefix["records"] == 1 and prefix["latest_batch"].hour == 2
    none = R.records_in_latest_batch(raw, "lake://nothing/%").first()
    assert none["records"] == 0 and none["latest_batch"] is None


def test_table_diff_both_ways(spark):
    from stationlake.operators.dedup import table_diff

    a = spark.createDataFrame([(1,), (1,), (2,)], "x INT")
    b = spark.createDataFrame([(1,), (3,)], "x INT")
    got = sorted((r["x"], r["side"]) for r in table_diff(a, b).collect())
    assert got == [(1, "left_only"), (2, "left_only"), (3, "right_only")]
    assert table_diff(a, a).count() == 0


def test_malformed_manifest_fails_loudly(spark, tmp_dir):
    path = f"{tmp_dir}/manifest"
    spark.createDataFrame([("PK", "not a date")], "country STRING, window_start STRING").write.parquet(path)
    with pytest.raises(Exception):
        R.read_manifest(spark, path).collect()


def test_failed_ids_of_checkpointed_chunks_are_rows(spark):
    outcomes = spark.createDataFrame(
        [("PK", dt.date(2026, 1, 1), dt.date(2026, 1, 3), True, True),
         ("PK", dt.date(2026, 1, 3), dt.date(2026, 1, 5), False, True)],
        "country_code STRING, chunk_start DATE, chunk_end DATE, passes BOOLEAN, matches BOOLEAN",
    )
    log = spark.createDataFrame(
        [("PK", dt.date(2026, 1, 1), dt.date(2026, 1, 3), 7, "failed"),
         ("PK", dt.date(2026, 1, 1), dt.date(2026, 1, 3), 8, "ok"),
         ("PK", dt.date(2026, 1, 3), dt.date(2026, 1, 5), 9, "failed")],
        "country_code STRING, chunk_start DATE, chunk_end DATE, sensor_id BIGINT, status STRING",
    )
    got = [(r["window_start"].day, r["sensor_id"]) for r in R.manifest_failed_records(outcomes, log, "2031-04-01 03:00:00").collect()]
    assert got == [(1, 7)]  # the gated-out chunk leaves no record
