"""A bucketed base of staged readings and loads merged into it equal staging everything at once."""

import random

import pytest
from helpers import page, raw_df, raw_row, reading, uri

from stationlake.operators import staging as S
from stationlake.plans import latest as L


def rows(df):
    return sorted(repr(tuple(r)) for r in df.select(*S.MEASUREMENT_COLUMNS).collect())


def load(rng, stamp, n=25):
    out = []
    for i in range(n):  # one page per object, so that every tie is decided
        records = [reading(float(rng.randrange(9)), f"2031-03-{rng.randrange(1, 5):02d} 0{rng.randrange(3)}:00:00") for _ in range(rng.randrange(3))]
        records += rng.choice(([], [7], [None]))  # entries that are no records have no period
        leaf = rng.choice((1, 2, 3, "nothing"))  # a leaf without a number has no sensor
        out.append(raw_row(page(*records), stamp, uri("NO", f"backfill/{i}", leaf)))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_loads_merge_to_what_a_whole_staging_gives(spark, tmp_dir, seed):
    rng = random.Random(seed)
    first, root = load(rng, "2031-03-05 02:00:00"), f"{tmp_dir}/latest"
    L.build_base(raw_df(spark, first), root, buckets=3)
    seen = list(first)
    for stamp in ("2031-03-06 02:00:00", "2031-03-05 01:00:00", "2031-03-06 02:00:00"):  # newer, older and equal stamps
        more = load(rng, stamp)
        seen += more
        L.merge_load(spark, raw_df(spark, more), root)
        assert rows(L.read_staged(spark, root)) == rows(S.stage_measurements(raw_df(spark, seen)))


def test_the_base_is_not_shuffled(spark, tmp_dir):
    rng, root = random.Random(5), f"{tmp_dir}/latest"
    L.build_base(raw_df(spark, load(rng, "2031-03-05 02:00:00")), root, buckets=4)
    new = L.newest_copies(raw_df(spark, load(rng, "2031-03-06 02:00:00")))
    plan = L.merged(L.base(spark, root), new)._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    scans = [i for i, line in enumerate(plan) if "stg_latest_" in line and "FileScan" in line]
    assert scans
    for i in scans:  # no Exchange among the operators above a scan of the base
        at = depth(plan[i])
        for j in range(i, -1, -1):
            if depth(plan[j]) < at:
                at = depth(plan[j])
                assert "Exchange" not in plan[j], plan[j]


def test_another_session_finds_the_newest_version(spark, tmp_dir):
    rng, root = random.Random(6), f"{tmp_dir}/latest"
    pages = load(rng, "2031-03-05 02:00:00")
    with pytest.raises(ValueError):
        L.base(spark, root)
    L.build_base(raw_df(spark, pages), root, buckets=2)
    L.merge_load(spark, raw_df(spark, load(rng, "2031-03-06 02:00:00")), root)
    before = rows(L.read_staged(spark, root))
    for name in [r["table_name"] for r in L.read_versions(spark, root).collect()]:
        spark.sql(f"DROP TABLE {name}")  # the files stay, the catalog forgets
    assert rows(L.read_staged(spark, root)) == before
    L.merge_load(spark, raw_df(spark, []), root)
    assert rows(L.read_staged(spark, root)) == before
