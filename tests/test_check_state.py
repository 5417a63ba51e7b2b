"""Uniqueness from stored counts: new and rewritten partitions against everything kept before."""

import datetime as dt
import random

import pytest

from stationlake.plans.check_state import UniqueState

SCHEMA = "sensor BIGINT, place BIGINT, day DATE"


def day(n):
    return dt.date(2031, 3, n)


def failing(rows, *columns):
    seen = {}
    for r in rows:
        key = tuple(r[c] for c in columns)
        seen[key] = seen.get(key, 0) + 1
    return sum(n > 1 for n in seen.values())


@pytest.mark.parametrize("keys,columns,decides", [(("sensor", "place"), (0, 1), False), (("sensor", "day"), (0, 2), True)])
def test_runs_over_new_and_rewritten_days(spark, tmp_dir, keys, columns, decides):
    rng = random.Random(3)
    state = UniqueState(f"{tmp_dir}/state", keys, "day", decides)
    rows = lambda d, n: [(rng.choice((None, 1, 2, 3)), rng.choice((None, *range(40))), day(d)) for _ in range(n)]
    table = {d: rows(d, 12) for d in (1, 2, 3)}
    whole = lambda: [r for part in table.values() for r in part]
    frame = lambda: spark.createDataFrame(whole(), SCHEMA)
    assert state.check(frame()) == failing(whole(), *columns)
    table |= {4: rows(4, 9), 5: rows(5, 1)}
    assert state.check(frame()) == failing(whole(), *columns)
    table |= {2: rows(2, 3), 4: []}  # rewritten, and emptied
    assert state.check(frame(), [day(2), day(4)]) == failing(whole(), *columns)
    assert state.check(frame()) == failing(whole(), *columns)  # nothing new
    runs = [(r["run"], r["partitions"], r["rows_read"]) for r in state.runs(spark).orderBy("run").collect()]
    assert runs == [(1, 3, 36), (2, 2, 10), (3, 2, 3), (4, 0, 0)]


def test_a_run_that_stopped_before_its_record_is_noticed(spark, tmp_dir, monkeypatch):
    state = UniqueState(f"{tmp_dir}/state", ("sensor",), "day")
    first, more = [(1, 0, day(1)), (1, 0, day(1)), (2, 0, day(1))], [(2, 0, day(2)), (3, 0, day(2))]
    assert state.check(spark.createDataFrame(first, SCHEMA)) == 1
    write = UniqueState._write

    def stops(self, *args):
        write(self, *args)
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(UniqueState, "_write", stops)
        with pytest.raises(RuntimeError):
            state.check(spark.createDataFrame(first + more, SCHEMA))
    last = [(3, 0, day(3))]
    assert state.check(spark.createDataFrame(first + more + last, SCHEMA)) == 3


def test_an_empty_table(spark, tmp_dir):
    state = UniqueState(f"{tmp_dir}/state", ("sensor",), "day")
    assert state.check(spark.createDataFrame([], SCHEMA)) == 0
