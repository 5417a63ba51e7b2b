"""Column expressions used across the model.  All are built-in Catalyst
expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationlake import constants as C


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, dt.datetime):
        return ts_lit(v)
    return F.lit(v)


def ts_lit(value) -> Column:
    """A timestamp literal read in the session time zone (UTC in this model).

    A Python ``datetime`` handed to ``F.lit`` is converted with the Python
    process's local zone; going through its ISO text keeps the wall-clock
    value whatever zone the driver process runs in.  Columns pass through.
    """
    if isinstance(value, Column):
        return value.cast("timestamp")
    if isinstance(value, dt.datetime):
        value = value.replace(tzinfo=None).isoformat(sep=" ")
    elif isinstance(value, dt.date):
        value = value.isoformat()
    return F.lit(value).cast("timestamp")


def regex_group_or_null(c: Column | str, pattern: str, group: int = 1) -> Column:
    """``regexp_extract`` that yields null, not ``''``, when nothing matches."""
    return F.nullif(F.regexp_extract(_col(c), pattern, group), F.lit(""))


def sensor_id_from_uri(uri: Column | str) -> Column:
    """Sensor id from the object leaf ``…/{id}.json``; null for other leaves."""
    return regex_group_or_null(uri, C.SENSOR_ID_PATTERN).cast("bigint")


def country_from_uri(uri: Column | str) -> Column:
    """Two-letter country code from ``…/raw/{source}/{CC}/…``; null otherwise."""
    return regex_group_or_null(uri, C.COUNTRY_PATTERN)


def day_segment(day: Column | str) -> Column:
    return F.date_format(_col(day), "yyyy-MM-dd")


def object_name(country: Column | str, partition: Column | str, leaf: Column | str) -> Column:
    """``raw/{source}/{COUNTRY}/{partition}/{leaf}.json``; the country code is
    upper-cased, as the identity pattern expects."""
    return F.concat(
        F.lit(C.RAW_PREFIX + "/"),
        F.upper(_col(country)),
        F.lit("/"),
        _col(partition),
        F.lit("/"),
        _col(leaf).cast("string"),
        F.lit(".json"),
    )


def chunk_label(start: Column | str, end: Column | str) -> Column:
    """``backfill/{start}_{end}`` with ISO dates."""
    return F.format_string(
        C.BACKFILL_SEGMENT + "/%s_%s", day_segment(start), day_segment(end)
    )


def iso_utc(ts: Column | str) -> Column:
    """Timestamp to the API's ``yyyy-MM-ddTHH:mm:ssZ`` form (session TZ is UTC)."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def in_half_open(ts: Column | str, lo, hi) -> Column:
    """``lo <= ts < hi``: abutting windows never share a row."""
    c = _col(ts)
    return (c >= _lit(lo)) & (c < _lit(hi))


def stable_round(c: Column | str, digits: int = 6) -> Column:
    """Round a double so that last-bit differences from summation order vanish.

    The small offset moves exact decimal midpoints (a mean like 38.3716875)
    off the rounding edge, so the neighbouring doubles round the same way.
    """
    return F.round(_col(c) + F.lit(1e-9), digits)


def rate_pct(numerator: Column | str, denominator: Column | str) -> Column:
    """numerator / denominator * 100, null when the denominator is 0 or null."""
    return F.try_divide(_col(numerator), _col(denominator)) * F.lit(100)
