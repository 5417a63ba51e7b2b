"""Layered build: staging → station-days → marts, with checks between layers.

Every layer is written to the shared folder once and read back with its
declared schema: staging (the pages are parsed once in the whole build), the
sensor-days and station-days, and both marts.  Checks and later layers read the
stored tables, so an executor lost later recomputes nothing before them.

The tables of a layer that do not need each other are written at the same
time.  Row-level checks are counted in the pass that writes a table; only key
and relationship checks read it again.  The report is one row per check; an
error-severity failure stops the build before the next layer, warnings are kept
in the report.  Empty inputs build empty tables.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from stationlake.operators import daily as D
from stationlake.operators import marts as M
from stationlake.operators import quality as Q
from stationlake.operators import staging as S
from stationlake.plans import checks as K
from stationlake.plans import incremental as IN
from stationlake.schemas import DQ_REPORT_DDL
from stationlake.session import at_once


class BuildFailed(RuntimeError):
    pass


@dataclass
class BuildResult:
    tables: dict[str, DataFrame]
    report: DataFrame
    paths: dict[str, str] = field(default_factory=dict)


@dataclass
class _Build:
    """Tables as they are stored, and what their checks found."""

    spark: SparkSession
    entries: list[tuple]
    run_id: str
    tables: dict[str, DataFrame] = field(default_factory=dict)
    counted: dict[str, list[tuple]] = field(default_factory=dict)
    rows: list[Row] = field(default_factory=list)

    def write(self, name: str, df: DataFrame, path: str, day: str | None = None) -> DataFrame:
        """Write ``df`` (by ``day``, if given, with as many files as its size asks for), counting its row checks."""
        checks = Q.row_checks(K.to_checks([e for e in self.entries if e[0] == name and e[1] in Q.ROW_LEVEL], {}).get(name, []))
        rows = df.hint("rebalance", day) if day else df
        seen = Observation(f"checks of {name}")
        if checks:
            # above the rebalance: counted by the tasks that write, once each
            rows = rows.observe(seen, *(Q.failing(c).alias(f"c{i}") for i, c in enumerate(checks)))
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(day) if day else writer).parquet(path)
        if checks:
            self.counted[name] = [Q.result_row(name, c, seen.get[f"c{i}"]) for i, c in enumerate(checks)]
        self.tables[name] = self.spark.read.schema(df.schema).parquet(path).select(*df.columns)
        return self.tables[name]

    def gate(self, layer: str) -> None:
        """Evaluate the layer's other checks and stop on a failure."""
        mine = [e for e in self.entries if e[0] in K.LAYERS[layer]]
        rest = [e for e in mine if e[0] not in self.counted or e[1] not in Q.ROW_LEVEL]
        rows = [r for name in K.LAYERS[layer] for r in self.counted.get(name, [])]
        if rest:
            rows += [tuple(r) for r in K.evaluate(rest, self.tables).collect()]  # one row per check
        failed = [r for r in rows if r[-1] == "fail"]
        self.rows += [(self.run_id, *r) for r in rows]
        if failed:
            names = ", ".join(f"{r[0]}.{r[1]}({r[2]})" for r in failed)
            raise BuildFailed(f"{layer} checks failed: {names}")


def build_all(
    spark: SparkSession,
    raw: DataFrame,
    thresholds: DataFrame,
    known_bad: DataFrame,
    out_dir: str,
    *,
    suite: list[tuple] | None = None,
    run_id: str | None = None,
) -> BuildResult:
    names = ("stg_measurements", "stg_locations", "stg_sensors", "int_sensor_days", "int_daily",
             "mart_country_compare", "mart_annual_compare")
    paths = {name: f"{out_dir}/{name}" for name in names}
    build = _Build(spark, suite if suite is not None else K.suite(), run_id or uuid.uuid4().hex[:12])
    tables = build.tables
    tables.update(thresholds=thresholds, known_bad=known_bad)

    def inventory() -> None:
        # Inventory pages feed both the location and the sensor staging: parsed once.
        S.location_records(raw).write.mode("overwrite").parquet(f"{out_dir}/location_records")
        records = spark.read.schema(S.location_records(raw).schema).parquet(f"{out_dir}/location_records")
        at_once(
            spark,
            lambda: build.write("stg_locations", S.stage_locations(raw, records), paths["stg_locations"]),
            lambda: build.write("stg_sensors", S.stage_sensors(raw, records), paths["stg_sensors"]),
        )

    def measurements() -> None:
        staged = S.stage_measurements(raw).withColumn("measurement_date", F.to_date("period_start_utc"))
        table = build.write("stg_measurements", staged, paths["stg_measurements"], "measurement_date")
        tables["stg_measurements"] = table.select(*S.MEASUREMENT_COLUMNS)

    at_once(spark, inventory, measurements)
    build.gate("staging")

    # by day: the layout the incremental update overwrites day by day
    IN.drop_index(spark, paths["int_sensor_days"])
    IN.write_by_day(D.sensor_day_agg(tables["stg_measurements"]), paths["int_sensor_days"], only_present_days=False)
    daily = IN.read_daily(spark, paths["int_sensor_days"], tables["stg_sensors"], tables["stg_locations"])
    build.write("int_daily", daily, paths["int_daily"], "measurement_date")
    build.gate("intermediate")

    at_once(
        spark,
        lambda: build.write("mart_country_compare", M.country_compare(tables["int_daily"], thresholds), paths["mart_country_compare"]),
        lambda: build.write("mart_annual_compare", M.annual_compare(tables["int_daily"], thresholds), paths["mart_annual_compare"]),
    )
    build.gate("marts")
    ordered = {name: tables[name] for name in ("stg_measurements", "stg_locations", "stg_sensors", "thresholds", "known_bad",
                                               "int_daily", "mart_country_compare", "mart_annual_compare")}
    return BuildResult(tables=ordered, report=spark.createDataFrame(build.rows, DQ_REPORT_DDL), paths=paths)


def layer_counts(result: BuildResult) -> DataFrame:
    """Rows per built table (one small aggregate per table)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in result.tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def register_views(result: BuildResult, prefix: str = "") -> list[str]:
    """Expose every built table to SQL under its model name.

    Every view reads the table's written files.  Returns the view names.
    """
    names = []
    for name, df in result.tables.items():
        view = f"{prefix}{name}"
        df.createOrReplaceTempView(view)
        names.append(view)
    return names
