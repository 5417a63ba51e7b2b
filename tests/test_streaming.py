"""Streaming forms give the batch result on the same pages."""

import os
import random

import pytest
from helpers import page, raw_df, raw_row, reading, uri
from pyspark.sql import functions as F

from stationlake.operators import staging as S
from stationlake.sources import pages as P
from stationlake.streaming import ingest as ST


def test_latest_wins_across_micro_batches(spark, tmp_dir):
    table = os.path.join(tmp_dir, "raw")
    first = [raw_row(page(reading(float(h), f"2026-07-06 {h:02d}:00:00")), "2026-07-07 02:05:00", uri("AE", "2026-07-06", 1)) for h in range(3)]
    P.append_batch(raw_df(spark, first), table)
    fix = [raw_row(page(reading(99.0, "2026-07-06 01:00:00")), "2026-07-08 02:05:00", uri("AE", "2026-07-07", 1))]
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")

    def run():
        recs = S.parse_measurements(S.measurement_records(ST.raw_table_stream(spark, table)))
        slim = recs.select("sensor_id", "period_start_utc", "measurement_value", "ingested_at", "source_uri", "record_pos")
        ST.run_update_stream(ST.latest_wins_stream(slim), out, ckpt).awaitTermination()

    run()
    P.append_batch(raw_df(spark, fix), table)
    run()  # resumes from the checkpoint: only the new file is read
    state = ST.current_state(spark, out, ["sensor_id", "period_start_utc"])
    got = {r["period_start_utc"].hour: r["measurement_value"] for r in state.collect()}
    assert got == {0: 0.0, 1: 99.0, 2: 2.0}
    batch = S.stage_measurements(P.read_raw(spark, table))
    assert {r["period_start_utc"].hour: r["measurement_value"] for r in batch.collect()} == got


def test_stream_ingest_stamps_one_batch(spark, tmp_dir):
    zone = os.path.join(tmp_dir, "zone")
    pages = spark.createDataFrame(
        [("AE", "2026-07-12", "1", '{"results": [1, 2]}'), ("AE", "2026-07-12", "locations", '{"results": [{"id": 1}]}')],
        "country STRING, part STRING, leaf STRING, body STRING",
    )
    P.write_pages(pages, zone)
    table, ckpt = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "ckpt")
    P.ensure_raw_table(spark, table)
    ST.ingest_pages_stream(ST.page_lines_stream(spark, zone, "lake://zone"), table, ckpt).awaitTermination()
    raw = P.read_raw(spark, table)
    assert raw.count() == 2 and raw.select("ingested_at").distinct().count() == 1
    assert raw.agg(P.page_record_total(raw)).first()[0] == 3  # 2 readings + 1 location
    assert raw.where(F.col("source_uri").endswith("/locations.json")).count() == 1


KEYS, ORDER = ["sensor_id", "period_start_utc"], ["ingested_at", "source_uri", "record_pos"]


def slim_stream(spark, table, max_files=None):
    recs = S.parse_measurements(S.measurement_records(ST.raw_table_stream(spark, table, max_files)))
    return recs.select(*KEYS, "measurement_value", *ORDER)


def by_day(df):
    return {r["period_start_utc"].day: r["measurement_value"] for r in df.collect()}


def test_corrections_behind_the_horizon_are_kept_aside(spark, tmp_dir):
    table, out, ckpt = (os.path.join(tmp_dir, x) for x in ("raw", "out", "ckpt"))
    days = [raw_row(page(reading(1.0, f"2026-07-{d:02d} 05:00:00")), f"2026-07-{d:02d} 23:00:00", uri("AE", f"2026-07-{d:02d}", 1))
            for d in range(1, 21)]
    P.append_batch(raw_df(spark, days), table)
    ST.corrections_stream(slim_stream(spark, table), out, ckpt).awaitTermination()
    late = [raw_row(page(reading(9.0, "2026-07-05 05:00:00")), "2026-07-21 02:05:00", uri("AE", "2026-07-20", 1)),
            raw_row(page(reading(8.0, "2026-07-19 05:00:00")), "2026-07-21 02:05:00", uri("AE", "2026-07-20", 1))]
    P.append_batch(raw_df(spark, late), table)
    recs = slim_stream(spark, table)
    ST.corrections_stream(recs, out, ckpt).awaitTermination()
    written = ST.read_corrections(spark, out, recs.schema)
    state, dropped = ST.corrected_state(written, KEYS, ORDER), ST.late_records(written)
    assert by_day(state)[5] == 1.0  # 15 days late: kept aside
    assert by_day(state)[19] == 8.0  # within the horizon: corrected
    assert by_day(dropped) == {5: 9.0}
    batch = by_day(S.stage_measurements(P.read_raw(spark, table)))
    assert batch[5] == 9.0 and by_day(ST.with_late_records(state, dropped, KEYS, ORDER)) == batch


@pytest.mark.parametrize("seed", range(2))
def test_no_record_is_lost_however_loads_fall_into_batches(spark, tmp_dir, seed):
    """Loads with corrections of any age; a trigger may find none, one or several, in batches of one file or all."""
    rng = random.Random(seed)
    table, out, ckpt = (os.path.join(tmp_dir, x) for x in ("raw", "out", "ckpt"))
    P.ensure_raw_table(spark, table)
    for load in range(6):
        rows = []
        for n in range(8):
            day = rng.randrange(1, 29)
            stamp = f"2026-08-{load + 1:02d} 0{rng.randrange(5)}:05:00"
            rows.append(raw_row(page(reading(float(load * 10 + n), f"2026-07-{day:02d} 05:00:00")), stamp, uri("AE", f"2026-07-{day:02d}", rng.randrange(3))))
        P.append_batch(raw_df(spark, rows).coalesce(rng.choice((1, 3))), table)
        if rng.random() < 0.6:
            ST.corrections_stream(slim_stream(spark, table, rng.choice((None, 1))), out, ckpt).awaitTermination()
    recs = slim_stream(spark, table)
    ST.corrections_stream(recs, out, ckpt).awaitTermination()
    written = ST.read_corrections(spark, out, recs.schema)
    merged = ST.with_late_records(ST.corrected_state(written, KEYS, ORDER), ST.late_records(written), KEYS, ORDER)
    batch = S.stage_measurements(P.read_raw(spark, table))
    rows = lambda df: sorted(tuple(r) for r in df.select(*KEYS, "measurement_value", "ingested_at").collect())
    assert rows(merged) == rows(batch)
