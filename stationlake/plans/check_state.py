"""Uniqueness checks that read new partitions only.

What a uniqueness check found is kept as a table of its own: per partition of
the checked table, its keys and how often they occur.  The parts are mergeable:
a run counts the keys of new or rewritten partitions, puts them in the place of
those partitions' old counts, and looks at other partitions' counts for these
keys alone.  The number of failing keys is carried from run to run, less what
the touched keys counted for before and plus what they count for now.

Where the key decides the partition (a measurement day is the day of its
period), equal keys lie in one partition and no other partition's counts are
read either.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.session import scratch_path

RUNS_DDL = "run BIGINT, partitions BIGINT, rows_read BIGINT, failures BIGINT"


@dataclass(frozen=True)
class UniqueState:
    """The state at ``path`` of a check that ``keys`` are unique in a table partitioned by ``day``."""

    path: str
    keys: tuple[str, ...]
    day: str
    key_decides_day: bool = False

    def runs(self, spark: SparkSession) -> DataFrame:
        """One row per run: partitions and rows that it read, failing keys of the whole table after it."""
        return self._read(spark, "runs", RUNS_DDL)

    def _read(self, spark: SparkSession, part: str, schema) -> DataFrame:
        try:
            return spark.read.schema(schema).parquet(f"{self.path}/{part}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    def _counts(self, spark: SparkSession, schema) -> DataFrame:
        return self._read(spark, "counts", schema)

    def _failing(self, counts: DataFrame, touched: DataFrame, days: list) -> int:
        """Keys of ``touched`` that occur more than once in ``counts``; null keys are equal to each other."""
        names = [f"k{i}" for i in range(len(self.keys))]
        if self.key_decides_day:
            mine = counts.where(F.col("part").isin(days))
        else:
            on = [counts[k].eqNullSafe(touched[k]) for k in names]
            mine = counts.join(touched, on, "left_semi")
        return mine.groupBy(*names).agg(F.sum("n").alias("n")).where("n > 1").count()

    def _write(self, fresh: DataFrame, days: list, run: int) -> None:
        """Put ``fresh`` in the place of the counts of ``days``; a day without keys keeps an empty mark."""
        spark = fresh.sparkSession
        gone = set(days) - {r[0] for r in fresh.select("part").distinct().collect()}
        if gone:
            marks = spark.createDataFrame([(d,) for d in gone], f"part {dict(fresh.dtypes)['part']}")
            fresh = fresh.unionByName(marks.withColumns({"n": F.lit(0).cast("bigint"), "run": F.lit(run).cast("bigint")}), allowMissingColumns=True)
        (
            fresh.hint("rebalance", "part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("part").parquet(f"{self.path}/counts")
        )

    def check(self, table: DataFrame, days: Sequence | None = None) -> int:
        """Failing keys of the whole ``table`` after reading its ``days`` (by default those not read yet).

        ``days`` names partitions that are new or were rewritten; the keys of one
        that is empty now are dropped from the state.  A run that stopped after
        it had written its counts is noticed by the next one, which counts the
        failing keys of the whole state once.
        """
        spark = table.sparkSession
        names = [f"k{i}" for i in range(len(self.keys))]
        picked = [F.col(k).alias(n) for k, n in zip(self.keys, names)]
        counted = lambda rows: rows.groupBy(*picked, F.col(self.day).alias("part")).agg(F.count(F.lit(1)).alias("n"))
        columns = [*names, "n", "run", "part"]
        schema = counted(table).withColumn("run", F.lit(0).cast("bigint")).select(*columns).schema
        old = self._counts(spark, schema)
        if days is None:
            known = old.select("part").distinct()
            days = [r[0] for r in table.select(F.col(self.day).alias("part")).distinct().join(known, "part", "left_anti").collect()]
        else:
            days = list(days)
        last = self.runs(spark).agg(F.max("run"), F.max_by("failures", "run")).first()
        ended, before = last[0] or 0, last[1] or 0
        begun = old.agg(F.max("run")).first()[0] or 0
        if begun > ended:
            before = old.groupBy(*names).agg(F.sum("n").alias("n")).where("n > 1").count()
        run = max(begun, ended) + 1
        fresh_path = scratch_path(spark, "fresh-keys")
        fresh = counted(table.where(F.col(self.day).isin(days) if days else F.lit(False)))
        fresh.withColumn("run", F.lit(run).cast("bigint")).select(*columns).write.parquet(fresh_path)
        fresh = spark.read.schema(schema).parquet(fresh_path)
        replaced = old.where(F.col("part").isin(days) if days else F.lit(False))
        touched_path = scratch_path(spark, "touched-keys")
        fresh.select(*names).unionByName(replaced.select(*names)).distinct().write.parquet(touched_path)
        touched = spark.read.schema(fresh.select(*names).schema).parquet(touched_path)
        was = self._failing(old, touched, days)
        kept = old.where(~F.col("part").isin(days)) if days else old
        now = self._failing(kept.unionByName(fresh), touched, days)
        self._write(fresh, days, run)
        failures = before - was + now
        read = fresh.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        spark.createDataFrame([(run, len(days), read, failures)], RUNS_DDL).coalesce(1).write.mode("append").parquet(f"{self.path}/runs")
        return failures
