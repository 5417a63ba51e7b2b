"""Presentation of query results for comparison with a SQL oracle.

Library functions return raw doubles and UTC timestamps.  Only this wrapper
rounds doubles (``round(x + 1e-9, 6)``, so summation order cannot flip a digit)
and hands timestamps out as wall-clock UTC values without a zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.functions.columns import stable_round


def for_compare(df: DataFrame) -> DataFrame:
    cols = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            c = stable_round(c, 6)
        elif isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(field.name))
    return df.select(*cols)
