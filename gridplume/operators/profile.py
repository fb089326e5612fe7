"""Quick looks at a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def frame_profile(df: DataFrame) -> DataFrame:
    """Row count, first and last date, and column names."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.lit(",".join(df.columns)).alias("columns"),
    )


def head_sample(df: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows by ``keys``, missing keys last: a top-k, not a full sort."""
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in keys]).limit(n)
