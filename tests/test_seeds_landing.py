"""Seeds, raw-zone writing and scanning, the load contract."""

import os

import pytest
from pyspark.sql import functions as F

from stationlake.sources import pages as P
from stationlake.sources.seeds import packaged_thresholds_path, read_thresholds, skip_set


def test_seed_equals_constants_both_ways(spark):
    seed = read_thresholds(spark, packaged_thresholds_path())
    consts = read_thresholds(spark)
    assert seed.exceptAll(consts).count() == 0 and consts.exceptAll(seed).count() == 0
    units = {r["unit"] for r in seed.collect()}
    assert units == {"µg/m³", "mg/m³"}


def test_skip_set_from_csv(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bad.csv")
    with open(path, "w") as f:
        f.write("note,sensor_id\nloose wire,71\nburied,3\nseen again,71\n")
    assert sorted(r[0] for r in skip_set(spark, path).collect()) == [3, 71]


def test_scan_reference_layout_lines_verbatim(spark, tmp_dir):
    base = os.path.join(tmp_dir, "raw", "airq", "NO", "2031-03-04")
    os.makedirs(base)
    bodies = ['{"page": 1, "results": [{"value": 0.25},   {"value": 8}]}', '{"results" : [ {"value": 1e1} ]}']
    with open(os.path.join(base, "771.json"), "w") as f:
        f.write("\n".join(bodies) + "\n")
    with open(os.path.join(base, "locations.json"), "w") as f:
        f.write('{"results": [{"id": 1}]}\n')
    lines = P.scan_pages(spark, [os.path.join(tmp_dir, "raw", "airq", "NO", "2031-03-04", "*")])
    rows = sorted((r["source_uri"].rsplit("/", 1)[1], r["value"]) for r in lines.collect())
    assert rows[0][0] == "771.json" and [v for _, v in rows[:2]] == sorted(bodies)
    raw = P.land_batch(lines, "2031-03-05 02:05:00")
    kinds = {r["k"]: r["n"] for r in raw.groupBy(P.page_kind().alias("k")).agg(P.page_record_total(raw).alias("n")).collect()}
    assert kinds == {"measurement": 3, "inventory": 1}
    assert raw.select("ingested_at").distinct().count() == 1


def test_malformed_line_fails_the_load(spark):
    good = '{"results": []}'
    bad = ["{oops", good + " tail", good + good, good + "," + good, "", '{"a": 1, "a": 2}', None]
    frame = lambda vs: spark.createDataFrame([(v, "x/1.json") for v in vs], "value STRING, source_uri STRING")
    assert P.invalid_page_lines(frame([good, *bad])).count() == len(bad)
    assert P.land_batch(frame([good]), "2031-03-05 02:05:00").count() == 1
    for line in bad:
        with pytest.raises(Exception, match="malformed page line"):
            P.land_batch(frame([good, line]), "2031-03-05 02:05:00").collect()


def test_write_pages_roundtrip_is_byte_exact(spark, tmp_dir):
    bodies = ['{"results": ["tab\tinside", 2]}', '{"results"  :[0.5]}']
    pages = spark.createDataFrame([("NO", "2031-03-04", "771", b) for b in bodies], "country STRING, part STRING, leaf STRING, body STRING")
    zone = os.path.join(tmp_dir, "zone")
    P.write_pages(pages, zone)
    back = P.scan_partitioned_pages(spark, zone, "lake://zone").collect()
    assert sorted(r["value"] for r in back) == sorted(bodies)
    assert {r["source_uri"] for r in back} == {"lake://zone/raw/airq/NO/2031-03-04/771.json"}


def test_raw_table_is_append_only(spark, tmp_dir):
    path = os.path.join(tmp_dir, "raw_table")
    P.ensure_raw_table(spark, path)
    P.ensure_raw_table(spark, path)
    lines = spark.createDataFrame([('{"results": [1]}', "lake://zone/raw/airq/NO/2031-03-04/1.json")], "value STRING, source_uri STRING")
    P.append_batch(P.land_batch(lines, "2031-03-05 02:05:00"), path)
    P.append_batch(P.land_batch(lines, "2031-03-05 05:00:00"), path)
    t = P.read_raw(spark, path)
    assert t.count() == 2 and t.select("ingested_at").distinct().count() == 2
    assert t.where(F.col("ingest_date").isNull()).count() == 0


def test_a_declared_table_refuses_what_is_no_raw_table(spark, tmp_dir):
    lines = spark.createDataFrame([('{"results": [1]}', "lake://zone/raw/airq/NO/2031-03-04/1.json")], "value STRING, source_uri STRING")
    path = os.path.join(tmp_dir, "raw")
    P.append_batch(P.land_batch(lines, "2031-03-05 02:05:00"), path)  # files that lie there already
    assert P.declare_raw_table(spark, "raw_declared", path).count() == 1
    P.load_batch(P.land_batch(lines, "2031-03-06 02:05:00"), "raw_declared")
    P.append_batch(P.land_batch(lines, "2031-03-07 02:05:00"), path)  # by another session
    assert P.declare_raw_table(spark, "raw_declared", path).count() == 3 == P.read_raw(spark, path).count()
    spark.sql("CREATE TABLE raw_other (raw_payload STRING, ingested_at DATE, source_uri STRING, ingest_date DATE)"
              f" USING parquet PARTITIONED BY (ingest_date) LOCATION '{tmp_dir}/other'")
    spark.sql("CREATE TABLE raw_unparted (raw_payload STRING, ingested_at TIMESTAMP, source_uri STRING, ingest_date DATE)"
              f" USING parquet LOCATION '{tmp_dir}/unparted'")
    batch = P.land_batch(lines, "2031-03-05 02:05:00")
    for name in ("raw_other", "raw_unparted"):
        with pytest.raises(P.RawTableMismatch):
            P.load_batch(batch, name)
        with pytest.raises(P.RawTableMismatch):
            P.declare_raw_table(spark, name, os.path.join(tmp_dir, "elsewhere-" + name))
    spark.range(3).write.parquet(os.path.join(tmp_dir, "numbers"))
    with pytest.raises(P.RawTableMismatch):
        P.declare_raw_table(spark, "raw_numbers", os.path.join(tmp_dir, "numbers"))
    for name in ("raw_declared", "raw_other", "raw_unparted"):
        spark.sql(f"DROP TABLE {name}")
