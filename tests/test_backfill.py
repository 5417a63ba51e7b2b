"""A backfill run over literal fetch logs and pages: gates that stop it, resuming from every stop."""

import datetime as dt

import pytest
from helpers import page, reading
from pyspark.sql import functions as F

from stationlake.operators import runs as R
from stationlake.operators.windows import plan_chunks
from stationlake.plans import backfill as B
from stationlake.sources import pages as P

LOG = "country_code STRING, chunk_start DATE, chunk_end DATE, sensor_id BIGINT, status STRING, measurements BIGINT"
PAGES = "country_code STRING, chunk_start DATE, chunk_end DATE, sensor_id BIGINT, body STRING"
CHUNKS = ((dt.date(2031, 3, 1), dt.date(2031, 3, 11)), (dt.date(2031, 3, 11), dt.date(2031, 3, 15)))


def inputs(spark, failed=(), overcounted=(), sensors=range(1, 11)):
    """Two chunks of NO, ten target sensors and one on the skip list; ``failed`` and ``overcounted`` are (chunk, sensor)."""
    windows = spark.createDataFrame([("NO", CHUNKS[0][0], CHUNKS[1][1])], "country_code STRING, window_start DATE, window_end DATE")
    log, pages = [], []
    for i, (lo, hi) in enumerate(CHUNKS):
        for s in (*sensors, 99):
            bad = (i, s) in failed
            n = 0 if bad else 1 + s % 2
            log.append(("NO", lo, hi, s, "failed" if bad else "ok", n + ((i, s) in overcounted)))
            if n:
                pages.append(("NO", lo, hi, s, page(*(reading(float(s), f"{lo} 0{h}:00:00") for h in range(n)))))
    ids = [("NO", s) for s in (*sensors, 99)]
    return {
        "chunks": plan_chunks(windows, 10).select("country_code", "chunk_start", "chunk_end", "chunk_label"),
        "targets": spark.createDataFrame(ids, "country_code STRING, sensor_id BIGINT"),
        "fetch_log": spark.createDataFrame(log, LOG),
        "pages": spark.createDataFrame(pages, PAGES),
        "inventory": spark.createDataFrame([("NO", '{"results": [{"id": 1}]}')], "country_code STRING, body STRING"),
        "skip": spark.createDataFrame([(99,)], "sensor_id BIGINT"),
    }


def outcome(spark, tables):
    """What a user sees after all runs: done windows, failed ids, records of each segment's newest batch."""
    manifest = R.read_manifest(spark, tables.manifest)
    done = sorted((r["window_start"], r["measurements"], r["sensors_with_data"], r["sensors_failed"]) for r in manifest.collect())
    failed = sorted(tuple(r) for r in R.read_manifest_failed(spark, tables.failed, manifest).select("window_start", "sensor_id").collect())
    batches = R.latest_batch_records(P.read_raw(spark, tables.raw))
    return done, failed, sorted((r["segment"], r["landed_records"]) for r in batches.collect())


def batches(spark, tables):
    return P.read_raw(spark, tables.raw).select("ingested_at").distinct().count()


def test_a_run_lands_reconciles_and_records(spark, tmp_path):
    tables = B.RunTables.under(str(tmp_path))
    B.run(spark, tables=tables, **inputs(spark, failed=[(1, 3)]), stamp="2031-04-01 02:00:00")
    done, failed, landed = outcome(spark, tables)
    assert [d[1:] for d in done] == [(15, 10, 0), (13, 9, 1)] and failed == [(CHUNKS[1][0], 3)]
    assert landed == [("backfill/2031-03-01_2031-03-11", 15), ("backfill/2031-03-11_2031-03-15", 13)]
    raw = P.read_raw(spark, tables.raw)
    uris = [r[0] for r in raw.select("source_uri").collect()]
    assert not any(u.endswith("/99.json") for u in uris)  # on the skip list
    assert [u for u in uris if u.endswith("/locations.json")] == ["lake://landing/raw/airq/NO/backfill/2031-03-01_2031-03-11/locations.json"]
    again = B.run(spark, tables=tables, **inputs(spark), stamp="2031-04-02 02:00:00")  # nothing is open
    assert again.count() == 2 and batches(spark, tables) == 1


def test_gates_leave_chunks_open(spark, tmp_path):
    tables = B.RunTables.under(str(tmp_path))
    first = inputs(spark, failed=[(0, s) for s in (1, 2, 3)], overcounted=[(1, 5)])
    with pytest.raises(B.RunStopped, match="NO backfill/2031-03-"):
        B.run(spark, tables=tables, **first, stamp="2031-04-01 02:00:00")
    assert outcome(spark, tables)[0] == []
    # Two of ten is not above the gate; the second chunk's count is right now.
    B.run(spark, tables=tables, **inputs(spark, failed=[(0, 1), (0, 2)]), stamp="2031-04-02 02:00:00")
    done, failed, _ = outcome(spark, tables)
    assert [d[2:] for d in done] == [(8, 2), (10, 0)] and failed == [(CHUNKS[0][0], 1), (CHUNKS[0][0], 2)]


def test_a_stamp_that_does_not_advance_is_refused(spark, tmp_path):
    tables = B.RunTables.under(str(tmp_path))
    with pytest.raises(B.RunStopped):
        B.run(spark, tables=tables, **inputs(spark, overcounted=[(1, 5)]), stamp="2031-04-02 02:00:00")
    with pytest.raises(ValueError, match="later"):
        B.run(spark, tables=tables, **inputs(spark), stamp="2031-04-02 02:00:00")


def test_a_country_without_targets_is_an_error(spark, tmp_path):
    given = inputs(spark)
    given["targets"] = given["targets"].where("sensor_id = 99")
    with pytest.raises(Exception, match="no target sensor"):
        B.run(spark, tables=B.RunTables.under(str(tmp_path)), **given)


class Stop(Exception):
    pass


WRITES = [(B, "append_batch"), (B, "append_markers"), (B.R, "append_manifest_failed"), (B.R, "append_manifest")]


@pytest.fixture(scope="module")
def unstopped(spark, tmp_path_factory):
    tables = B.RunTables.under(str(tmp_path_factory.mktemp("whole")))
    B.run(spark, tables=tables, **inputs(spark, failed=[(1, 3)]), stamp="2031-04-01 02:00:00")
    return outcome(spark, tables)


@pytest.mark.parametrize(
    "module,name,after", [(B, "append_batch", False), *((m, n, True) for m, n in WRITES)], ids=["before any", *(f"after {n}" for _, n in WRITES)]
)
def test_stopped_around_any_write_a_run_is_resumed(spark, tmp_path, monkeypatch, unstopped, module, name, after):
    stopped = B.RunTables.under(str(tmp_path))
    given = inputs(spark, failed=[(1, 3)])
    real = getattr(module, name)

    def breaks(*args, **kwargs):
        if after:
            real(*args, **kwargs)
        raise Stop

    with monkeypatch.context() as m:
        m.setattr(module, name, breaks)
        with pytest.raises(Stop):
            B.run(spark, tables=stopped, **given, stamp="2031-04-01 02:00:00")
    B.run(spark, tables=stopped, **given, stamp="2031-04-02 02:00:00")
    assert outcome(spark, stopped) == unstopped
    # Pages without a marker are landed again; with it, or before them, once.
    assert batches(spark, stopped) == (2 if (name, after) == ("append_batch", True) else 1)


def test_a_batch_that_was_landed_in_part_is_landed_again(spark, tmp_path, monkeypatch):
    tables, given = B.RunTables.under(str(tmp_path)), inputs(spark)
    real = B.append_batch

    def half(batch, path):
        real(batch.where(F.xxhash64("source_uri") % 2 == 0), path)

    with monkeypatch.context() as m:
        m.setattr(B, "append_batch", half)
        with pytest.raises(B.RunStopped):
            B.run(spark, tables=tables, **given, stamp="2031-04-01 02:00:00")
    B.run(spark, tables=tables, **given, stamp="2031-04-02 02:00:00")
    assert [d[1] for d in outcome(spark, tables)[0]] == [15, 15]
