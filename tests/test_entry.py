"""Driver contract: entry runs, every query has a matching oracle key, and a
sample of queries matches its oracle on sf0.001."""

import datetime as dt
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 14
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(E.queries()) - set(E.LLM_QUERIES) == set(E.oracle_sql()) - set(E.LLM_ORACLES)
    assert set(E.LLM_ORACLES) <= set(E.LLM_QUERIES)


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("key", [
    "country_compare", "annual_compare", "gap_audit_monthly", "stage_locations",
    "reconcile_counts", "dq_not_null", "lookback_window", "rolling_7d_range",
])
def test_query_matches_oracle(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[key](spark, SF)
    res = con.sql(E.oracle_sql()[key])
    assert sorted(df.columns) == sorted(res.columns)
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(res.columns, res.fetchall())


def test_public_reader_reads_the_whole_zone(spark, monkeypatch):
    """The scan_pages key reads every page of every country and day by scan_pages, in all path forms."""
    from stationlake.plans import queries as PQ
    from stationlake.sources import pages as P

    calls, real = [], P.scan_pages

    def kept(spark_, paths, **how):
        calls.append((paths, how, real(spark_, paths, **how)))
        return calls[-1][2]

    monkeypatch.setattr(P, "scan_pages", kept)
    PQ.QUERIES["scan_pages"](spark, SF)
    got = Counter()
    for _, _, lines in calls:
        counts = lines.groupBy(PQ.zone_folder("country"), PQ.zone_folder("part")).count()
        got.update({(c, p): n for c, p, n in counts.collect()})
    zone = spark.read.schema(P.PARTITIONED_TEXT_SCHEMA).text(PQ.written_zone(spark, SF))
    assert got == {(c, p): n for c, p, n in zone.groupBy("country", "part").count().collect()} and got
    assert any(how.get("recursive") for _, how, _ in calls) and any("*" in paths[0] for paths, _, _ in calls) and len(calls) == 3
