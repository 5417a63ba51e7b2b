"""The model's declarative check suite and its evaluation.

The suite is plain data: (table, kind, columns, severity, options).  The Spark
side turns it into :class:`stationlake.operators.quality.Check` objects; the
SQL oracle turns the same entries into one counting query per check.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from stationlake import constants as C
from stationlake.operators import quality as Q

# --- fixed values: accepted lists of the event world --------------------------
EVENT_COUNTRIES = ("AF", "AM", "AS", "EU", "MI")
EVENT_PARAMETERS = ("pm25", "pm10", "no2", "o3", "co")


def suite(countries=EVENT_COUNTRIES, parameters=EVENT_PARAMETERS) -> list[tuple]:
    """(table, kind, columns, severity, options) for every model check."""
    units = C.SEED_UNITS
    s: list[tuple] = []

    def add(table, kind, cols, severity="error", **opts):
        s.append((table, kind, tuple(cols) if not isinstance(cols, str) else (cols,), severity, opts))

    # staging
    add("stg_measurements", "unique_combination", ["sensor_id", "period_start_utc"])
    add("stg_measurements", "not_null", "sensor_id")
    add("stg_measurements", "relationships", "sensor_id", parent="stg_sensors", parent_column="sensor_id")
    add("stg_measurements", "not_null", "country_code")
    add("stg_measurements", "accepted_values", "country_code", values=countries)
    add("stg_measurements", "not_null", "parameter")
    add("stg_measurements", "accepted_values", "parameter", values=parameters)
    add("stg_measurements", "not_null", "measurement_value", severity="warn")
    add("stg_measurements", "not_null", "unit")
    add("stg_measurements", "accepted_values", "unit", values=units)
    add("stg_measurements", "not_null", "period_start_utc")
    add("stg_locations", "unique", "location_id")
    add("stg_locations", "not_null", "location_id")
    add("stg_locations", "not_null", "country_code")
    add("stg_locations", "accepted_values", "country_code", values=countries)
    add("stg_locations", "not_null", "is_reference_monitor")
    add("stg_sensors", "unique", "sensor_id")
    add("stg_sensors", "not_null", "sensor_id")
    add("stg_sensors", "not_null", "location_id")
    add("stg_sensors", "relationships", "location_id", parent="stg_locations", parent_column="location_id")
    add("stg_sensors", "not_null", "parameter")
    # intermediate
    add("int_daily", "unique_combination", ["location_id", "parameter", "measurement_date"])
    add("int_daily", "not_null", "location_id")
    add("int_daily", "not_null", "parameter")
    add("int_daily", "not_null", "measurement_date")
    add("int_daily", "not_null", "daily_avg")
    add("int_daily", "not_null", "reading_count")
    add("int_daily", "accepted_range", "reading_count", min_value=1)
    add("int_daily", "not_null", "hours_covered")
    add("int_daily", "accepted_range", "hours_covered", min_value=1, max_value=24)
    # marts
    add("mart_country_compare", "unique_combination", ["country_code", "parameter", "measurement_date"])
    add("mart_country_compare", "not_null", "country_code")
    add("mart_country_compare", "accepted_values", "country_code", values=countries)
    add("mart_country_compare", "not_null", "parameter")
    add("mart_country_compare", "not_null", "measurement_date")
    add("mart_country_compare", "not_null", "locations_with_data")
    add("mart_country_compare", "accepted_range", "locations_with_data", min_value=1)
    add("mart_country_compare", "accepted_range", "exceedance_rate", min_value=0, max_value=100)
    add("mart_annual_compare", "unique_combination", ["country_code", "parameter", "measurement_year"])
    add("mart_annual_compare", "not_null", "country_code")
    add("mart_annual_compare", "not_null", "parameter")
    add("mart_annual_compare", "not_null", "measurement_year")
    add("mart_annual_compare", "not_null", "annual_mean")
    add("mart_annual_compare", "not_null", "days_with_data")
    add("mart_annual_compare", "accepted_range", "days_with_data", min_value=1)
    add("mart_annual_compare", "not_null", "locations_with_data")
    add("mart_annual_compare", "accepted_range", "locations_with_data", min_value=1)
    # seeds
    add("thresholds", "not_null", "pollutant")
    add("thresholds", "accepted_values", "pollutant", values=C.SEED_POLLUTANTS)
    add("thresholds", "not_null", "averaging_period")
    add("thresholds", "accepted_values", "averaging_period", values=C.SEED_PERIODS)
    add("thresholds", "not_null", "threshold_value")
    add("thresholds", "not_null", "unit")
    add("thresholds", "accepted_values", "unit", values=C.SEED_UNITS)
    add("thresholds", "unique_combination", ["pollutant", "averaging_period"])
    add("known_bad", "unique", "sensor_id")
    add("known_bad", "not_null", "sensor_id")
    add("known_bad", "not_null", "country_code")
    add("known_bad", "accepted_values", "country_code", values=countries)
    add("known_bad", "not_null", "first_seen_failing")
    add("known_bad", "not_null", "last_verified_failing")
    return s


LAYERS = {
    "staging": ("stg_measurements", "stg_locations", "stg_sensors", "thresholds", "known_bad"),
    "intermediate": ("int_daily",),
    "marts": ("mart_country_compare", "mart_annual_compare"),
}


def to_checks(entries: Iterable[tuple], tables: dict[str, DataFrame]) -> dict[str, list[Q.Check]]:
    out: dict[str, list[Q.Check]] = {}
    for table, kind, cols, severity, opts in entries:
        if kind == "relationships":
            chk = Q.Check(kind, cols, severity, parent=tables[opts["parent"]],
                          parent_column=opts["parent_column"])
        else:
            chk = Q.Check(kind, cols, severity, values=tuple(opts.get("values", ())),
                          min_value=opts.get("min_value"), max_value=opts.get("max_value"))
        out.setdefault(table, []).append(chk)
    return out


def evaluate(entries: Iterable[tuple], tables: dict[str, DataFrame]) -> DataFrame:
    """One report for all entries: one pass per table for row-level checks."""
    by_table = to_checks(entries, tables)
    report = None
    for table, checks in by_table.items():
        part = Q.run_checks(table, tables[table], checks)
        report = part if report is None else report.unionByName(part)
    return report


def select(kind: str | tuple[str, ...], tables: Iterable[str] | None = None) -> list[tuple]:
    kinds = (kind,) if isinstance(kind, str) else kind
    keep = set(tables) if tables is not None else None
    return [e for e in suite() if e[1] in kinds and (keep is None or e[0] in keep)]


# --- SQL form of the same suite (used by the oracles) -----------------------------


def _sql_list(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def check_sql(entry: tuple) -> str:
    table, kind, cols, severity, opts = entry
    c = cols[0]
    if kind == "not_null":
        n = f"(SELECT count(*) FROM {table} WHERE {c} IS NULL)"
    elif kind == "accepted_values":
        n = f"(SELECT count(*) FROM {table} WHERE {c} IS NOT NULL AND {c} NOT IN ({_sql_list(opts['values'])}))"
    elif kind == "accepted_range":
        conds = []
        if opts.get("min_value") is not None:
            conds.append(f"{c} < {opts['min_value']}")
        if opts.get("max_value") is not None:
            conds.append(f"{c} > {opts['max_value']}")
        n = f"(SELECT count(*) FROM {table} WHERE {c} IS NOT NULL AND ({' OR '.join(conds)}))"
    elif kind == "unique":
        n = (f"(SELECT count(*) FROM (SELECT {c} FROM {table} WHERE {c} IS NOT NULL "
             f"GROUP BY {c} HAVING count(*) > 1))")
    elif kind == "unique_combination":
        cl = ", ".join(cols)
        n = f"(SELECT count(*) FROM (SELECT {cl} FROM {table} GROUP BY {cl} HAVING count(*) > 1))"
    elif kind == "relationships":
        p, pc = opts["parent"], opts["parent_column"]
        n = (f"(SELECT count(*) FROM {table} t WHERE t.{c} IS NOT NULL AND NOT EXISTS "
             f"(SELECT 1 FROM {p} q WHERE q.{pc} = t.{c}))")
    else:
        raise ValueError(kind)
    return (
        f"SELECT '{table}' AS table_name, '{kind}' AS check_name, '{','.join(cols)}' AS column_name, "
        f"'{severity}' AS severity, CAST({n} AS BIGINT) AS failures, "
        f"CASE WHEN {n} = 0 THEN 'pass' WHEN '{severity}' = 'warn' THEN 'warn' ELSE 'fail' END AS status"
    )


def report_sql(entries: Iterable[tuple]) -> str:
    return "\nUNION ALL\n".join(check_sql(e) for e in entries)


#: Faults planted for the check queries: per table the changed columns, and the
#: rows that occur twice.  The texts are read by Spark and by the SQL oracles.
FAULTS: dict[str, tuple[dict[str, str], str]] = {
    "stg_measurements": ({
        "sensor_id": "CASE WHEN sensor_id % 97 = 5 THEN NULL WHEN sensor_id % 89 = 3 THEN sensor_id + 10000000 ELSE sensor_id END",
        "country_code": "CASE WHEN sensor_id % 83 = 1 THEN 'XX' WHEN sensor_id % 83 = 2 THEN NULL ELSE country_code END",
        "parameter": "CASE WHEN sensor_id % 79 = 1 THEN 'dust' WHEN sensor_id % 79 = 2 THEN NULL ELSE parameter END",
        "unit": "CASE WHEN sensor_id % 73 = 1 THEN 'ppm' WHEN sensor_id % 73 = 2 THEN NULL ELSE unit END",
    }, "sensor_id % 71 = 4"),
    "stg_locations": ({
        "country_code": "CASE WHEN location_id = 3 THEN 'XX' WHEN location_id = 4 THEN NULL ELSE country_code END",
        "is_reference_monitor": "CASE WHEN location_id = 5 THEN NULL ELSE is_reference_monitor END",
    }, "location_id % 10 = 7"),
    "stg_sensors": ({
        "location_id": "CASE WHEN sensor_id % 67 = 1 THEN 999 WHEN sensor_id % 67 = 2 THEN NULL ELSE location_id END",
        "parameter": "CASE WHEN sensor_id % 61 = 1 THEN NULL ELSE parameter END",
    }, "sensor_id % 59 = 6"),
    "int_daily": ({
        "reading_count": "CASE WHEN location_id % 4 = 1 THEN 0 ELSE reading_count END",
        "hours_covered": "CASE WHEN location_id % 4 = 2 THEN 25 WHEN location_id % 4 = 3 THEN NULL ELSE hours_covered END",
        "daily_avg": "CASE WHEN location_id % 7 = 3 THEN NULL ELSE daily_avg END",
    }, "location_id % 5 = 0"),
    "mart_country_compare": ({
        "country_code": "CASE WHEN parameter = 'no2' THEN 'XX' ELSE country_code END",
        "exceedance_rate": "CASE WHEN country_code = 'EU' THEN 150.0 ELSE exceedance_rate END",
        "locations_with_data": "CASE WHEN country_code = 'AF' THEN 0 ELSE locations_with_data END",
    }, "country_code = 'AM' AND parameter = 'pm25'"),
    "mart_annual_compare": ({
        "days_with_data": "CASE WHEN country_code = 'AF' THEN 0 ELSE days_with_data END",
        "locations_with_data": "CASE WHEN country_code = 'AS' THEN 0 ELSE locations_with_data END",
        "annual_mean": "CASE WHEN country_code = 'EU' THEN NULL ELSE annual_mean END",
    }, "country_code = 'AM'"),
    "known_bad": ({
        "country_code": "CASE WHEN sensor_id % 7 = 3 THEN 'XX' WHEN sensor_id % 7 = 4 THEN NULL ELSE country_code END",
    }, "sensor_id % 5 = 1"),
}


def with_faults(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``tables`` with FAULTS in them, so that checks of every kind find something."""
    out = dict(tables)
    for name, (changed, twice) in FAULTS.items():
        df = tables[name]
        both = df.unionAll(df.where(twice))
        out[name] = both.selectExpr(*(f"{changed[c]} AS {c}" if c in changed else c for c in df.columns))
    return out


def faults_sql(ctes: str) -> str:
    """A query text of model-table CTEs, with the faulty tables in the place of the sound ones."""
    made = []
    for name, (changed, twice) in FAULTS.items():
        ctes = ctes.replace(f"\n{name} AS (", f"\nsound_{name} AS (")
        replaced = ", ".join(f"{e} AS {c}" for c, e in changed.items())
        made.append(
            f"{name} AS (SELECT * REPLACE ({replaced}) FROM "
            f"(SELECT * FROM sound_{name} UNION ALL SELECT * FROM sound_{name} WHERE {twice}))"
        )
    return ctes.rstrip() + ",\n" + ",\n".join(made) + "\n"
