"""Declarative checks: one-pass row checks, keys, relationships, freshness."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stationlake.operators import quality as Q
from stationlake.plans import checks as K


def test_row_checks_nulls_pass_values_and_ranges(spark):
    df = spark.createDataFrame(
        [(1, "AE", 5), (2, None, 30), (2, "XX", None), (None, "PK", 0)],
        "id BIGINT, cc STRING, hours BIGINT",
    )
    parent = spark.createDataFrame([(1,), (3,)], "id BIGINT")
    checks = [
        Q.not_null("id"),
        Q.not_null("cc", severity="warn"),
        Q.accepted_values("cc", ["AE", "PK"]),
        Q.accepted_range("hours", 1, 24),
        Q.unique("id"),
        Q.unique_combination(["id", "cc"]),
        Q.relationships("id", parent, "id"),
    ]
    got = {(r["check_name"], r["column_name"]): (r["failures"], r["status"])
           for r in Q.run_checks("t", df, checks).collect()}
    assert got[("not_null", "id")] == (1, "fail")
    assert got[("not_null", "cc")] == (1, "warn")
    assert got[("accepted_values", "cc")] == (1, "fail")
    assert got[("accepted_range", "hours")] == (2, "fail")
    assert got[("unique", "id")] == (1, "fail")
    assert got[("unique_combination", "id,cc")] == (0, "pass")
    assert got[("relationships", "id")] == (2, "fail")


def test_row_level_checks_are_one_aggregate(spark):
    df = spark.range(10).withColumn("x", F.col("id") % 3)
    report = Q.run_checks("t", df, [Q.not_null("id"), Q.not_null("x"), Q.accepted_range("x", 0, 1)])
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") <= 2  # partial + final of a single aggregate


def test_freshness_levels(spark):
    ref = dt.datetime(2026, 7, 20, 12, 0, 0)
    rows = [("a", ref - dt.timedelta(hours=29)), ("b", ref - dt.timedelta(hours=31)), ("c", ref - dt.timedelta(hours=55))]
    df = spark.createDataFrame(rows, "src STRING, ingested_at TIMESTAMP")
    got = {r["src"]: r["freshness"] for r in Q.freshness(df, "ingested_at", ref, ["src"]).collect()}
    assert got == {"a": "pass", "b": "warn", "c": "error"}


def test_nonempty_guard(spark):
    countries = spark.createDataFrame([("AE",), ("PK",)], "country_code STRING")
    sensors = spark.createDataFrame([("PK", 1)], "country_code STRING, sensor_id BIGINT")
    got = {r["country_code"]: (r["n"], r["status"]) for r in Q.nonempty_guard(countries, sensors, "country_code", "n").collect()}
    assert got == {"AE": (0, "fail"), "PK": (1, "pass")}


def test_gate_fails_the_job_that_reads_the_report(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id BIGINT, x INT")
    warned = Q.run_checks("t", df, [Q.not_null("id"), Q.not_null("x", severity="warn")])
    assert Q.gate(warned).count() == 2
    failed = Q.run_checks("t", df, [Q.not_null("id"), Q.not_null("x")])
    with pytest.raises(Exception, match="data-quality check failed"):
        Q.gate(failed).count()


def test_suite_has_sixty_one_checks():
    s = K.suite()
    assert len(s) == 61
    assert sum(1 for e in s if e[0].startswith("stg_")) == 21
    assert sum(1 for e in s if e[0] == "int_daily") == 9
    assert sum(1 for e in s if e[0].startswith("mart_")) == 17
    assert sum(1 for e in s if e[0] in ("thresholds", "known_bad")) == 14
