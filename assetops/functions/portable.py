"""Results with types every SQL engine and pandas agree on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def portable(df: DataFrame) -> DataFrame:
    """Lower-case names; integers as BIGINT, decimals as DOUBLE, days as text."""
    out = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            col = col.cast("bigint")
        elif isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            col = col.cast("double")
        elif isinstance(field.dataType, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        out.append(col.alias(field.name.lower()))
    return df.select(*out)
