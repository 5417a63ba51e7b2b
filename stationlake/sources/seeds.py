"""Reference tables: guideline thresholds and the known-bad sensor list.

Both are small by construction (one row per pollutant and period; one row per
sensor known to fail upstream) and are read with declared types.
"""

from __future__ import annotations

from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake import constants as C
from stationlake.schemas import KNOWN_BAD_DDL, THRESHOLDS_DDL


def packaged_thresholds_path() -> str:
    return str(resources.files("stationlake") / "data" / "thresholds.csv")


def read_thresholds(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The guideline table: the declared rows, or a CSV seed (UTF-8, header row) read with declared types.

    By default nothing is read: a file inside the installed package is on the
    driver only.
    """
    if path is None:
        return thresholds_from_constants(spark)
    return (
        spark.read.schema(THRESHOLDS_DDL)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def thresholds_from_constants(spark: SparkSession) -> DataFrame:
    """The same guideline table built from :data:`constants.WHO_THRESHOLDS`."""
    return spark.createDataFrame(list(C.WHO_THRESHOLDS), THRESHOLDS_DDL)


def read_known_bad(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema(KNOWN_BAD_DDL)
        .option("header", True)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def skip_set(spark: SparkSession, path: str) -> DataFrame:
    """Sensor ids from any CSV with a ``sensor_id`` column, as a distinct set."""
    return (
        spark.read.option("header", True)
        .csv(path)
        .select(F.col("sensor_id").cast("bigint").alias("sensor_id"))
        .distinct()
    )
