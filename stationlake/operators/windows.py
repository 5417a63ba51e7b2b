"""Date windows: half-open filters, backfill chunk plans and lookback windows.

Windows are rows, not driver loops: a table of ``(country, window_start,
window_end)`` is tiled into abutting half-open chunks with
``explode(sequence(...))``, so planning many countries or long spans is one
narrow projection.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake import constants as C
from stationlake.functions.columns import chunk_label, in_half_open, ts_lit


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    if isinstance(x, dt.datetime):
        return ts_lit(x)
    return F.lit(x)


def half_open_filter(df: DataFrame, ts: str, lo, hi) -> DataFrame:
    """Rows with ``lo <= ts < hi``."""
    return df.where(in_half_open(ts, lo, hi))


def plan_chunks(
    windows: DataFrame,
    chunk_days: int | str | Column = C.DEFAULT_CHUNK_DAYS,
    start: str = "window_start",
    end: str = "window_end",
) -> DataFrame:
    """Tile each ``[start, end)`` into abutting chunks of ``chunk_days`` days.

    The last chunk is truncated at ``end``.  An empty or inverted window, or a
    chunk width below 1, fails the job with a clear message.  Output adds
    ``chunk_start``, ``chunk_end`` and ``chunk_label``
    (``backfill/{start}_{end}``).
    """
    n = _c(chunk_days).cast("int")
    s, e = F.col(start), F.col(end)
    checked_n = F.when(
        n < 1, F.raise_error(F.format_string("a chunk needs at least one day: %s", n))
    ).otherwise(n)
    checked_end = F.when(
        s >= e,
        F.raise_error(F.format_string("no days to tile from %s up to %s", s, e)),
    ).otherwise(e)
    step = F.make_dt_interval(days=checked_n)
    tiled = windows.withColumn(
        "chunk_start", F.explode(F.sequence(s, F.date_sub(checked_end, 1), step))
    )
    cs = F.col("chunk_start")
    return tiled.withColumn("chunk_end", F.least(F.date_add(cs, checked_n), e)).withColumn(
        "chunk_label", chunk_label("chunk_start", "chunk_end")
    )


def chunk_start_of(day: Column | str, span_start: Column | str, chunk_days: int) -> Column:
    """Start of the chunk holding ``day`` when ``[span_start, …)`` is tiled by
    ``chunk_days`` — the equi-join key that replaces a range join."""
    d, s = _c(day), _c(span_start)
    offset = F.floor(F.datediff(d, s) / chunk_days) * chunk_days
    return F.date_add(s, offset.cast("int"))


def lookback_bounds(ds: Column | str | dt.date, days: int = C.LOOKBACK_DAYS) -> tuple[Column, Column]:
    """``[ds − (days − 1), ds + 1)``: the window a run for day ``ds`` re-fetches."""
    d = _c(ds)
    return F.date_sub(d, days - 1), F.date_add(d, 1)


def runs_covering(day: Column | str, days: int = C.LOOKBACK_DAYS) -> Column:
    """All run days whose lookback window holds ``day`` (``day … day + days − 1``)."""
    d = _c(day)
    return F.sequence(d, F.date_add(d, days - 1))
