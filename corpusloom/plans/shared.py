"""Small helpers used by the query modules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, so that sums of different order compare equal."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def r6(sql: str, digits: int = 6) -> str:
    return f"round(CAST({sql} AS DOUBLE), {digits})"
