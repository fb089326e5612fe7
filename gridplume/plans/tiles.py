"""The queries behind the two dashboard tiles."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridplume.sources.lake import in_range

_GENERATION = "total_gross_load_mw"


def date_range_filter(df: DataFrame, first: date | None, last: date | None) -> DataFrame:
    """The dashboard's date control; an open end leaves that side unbounded."""
    return in_range(df, first, last)


def year_of_date(df: DataFrame) -> DataFrame:
    return df.withColumn("year", F.year("date"))


def daily_generation(over_time: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """Generation per date, all states."""
    rows = date_range_filter(over_time, first, last)
    return rows.groupBy("date").agg(F.sum(_GENERATION).alias(_GENERATION))


def daily_generation_by_state(over_time: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    rows = date_range_filter(over_time, first, last)
    return rows.groupBy("date", "state").agg(F.sum(_GENERATION).alias(_GENERATION))


def yearly_fuel_mix(by_fuel: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    rows = year_of_date(date_range_filter(by_fuel, first, last))
    return rows.groupBy("year", "fuel_category").agg(F.sum(_GENERATION).alias(_GENERATION))


def fuel_share(by_fuel: DataFrame) -> DataFrame:
    """Extension: each fuel's share of its year. The window runs over the yearly mix, at most nine rows a year."""
    year = Window.partitionBy("year")
    share = F.col(_GENERATION) / F.nullif(F.sum(_GENERATION).over(year), F.lit(0.0))
    return yearly_fuel_mix(by_fuel).withColumn("share", share)
