"""Shaping and the hourly-to-daily roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridplume import fixtures as fx
from gridplume.operators import profile, shaping
from gridplume.registered import common as c
from gridplume.schemas import DAILY_KEYS, MEASURES
from gridplume.session import work_path
from gridplume.sources import landing


def rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = shaping.hourly_to_daily(shaping.shape_hourly(c.cems_hourly(spark, sf_dir)))
    return daily.withColumn("facility_id", F.col("facility_id").cast("bigint"))


def hourly_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_path(spark, "landing")
    fx.land(fx.with_folders(c.cems_hourly(spark, sf_dir)), root)
    return landing.hourly_scan(spark, root).drop("chunk_state", "snapshot")


def select_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaping.select_rename(c.cems_hourly(spark, sf_dir))


def coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaping.coerce_numeric(select_rename(spark, sf_dir))


def parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = shaping.parse_date(select_rename(spark, sf_dir))
    return days.groupBy("date").agg(F.count(F.lit(1)).alias("readings"))


def measure_float64(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = shaping.measure_float64(shaping.coerce_numeric(select_rename(spark, sf_dir)))
    return typed.select("state", *[F.typeof(m).alias(f"type_{m}") for m in MEASURES], *MEASURES)


def stamp_ingested_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = shaping.stamp_ingested_at(shaping.select_rename(c.cems_hourly(spark, sf_dir)), c.RUN_TS)
    seconds = F.unix_seconds("ingested_at").alias("ingested_at_seconds")
    return stamped.groupBy("state", seconds).agg(F.count(F.lit(1)).alias("readings"))


def hourly_to_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.rounded(rolled(spark, sf_dir), *MEASURES)


def frame_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.frame_profile(rolled(spark, sf_dir).select(*DAILY_KEYS, *MEASURES))


def head_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.rounded(profile.head_sample(rolled(spark, sf_dir), DAILY_KEYS), *MEASURES)


QUERIES = {
    "hourly_scan": hourly_scan,
    "select_rename": select_rename,
    "coerce_numeric": coerce_numeric,
    "parse_date": parse_date,
    "measure_float64": measure_float64,
    "stamp_ingested_at": stamp_ingested_at,
    "hourly_to_daily": hourly_to_daily,
    "frame_profile": frame_profile,
    "head_sample": head_sample,
}

_types = ", ".join(f"'double' as type_{m}" for m in c.SQL_MEASURES)
_columns = ",".join([*c.SQL_KEYS, *c.SQL_MEASURES])
ORACLE = {
    "hourly_scan": f"""select {c.SQL_FIELDS}, cast(year(cast(date as date)) as int) as chunk_year,
      cast(month(cast(date as date)) as int) as chunk_month from ({c.HOURLY_SQL})""",
    "select_rename": c.RENAMED_SQL,
    "coerce_numeric": c.COERCED_SQL,
    "parse_date": f"select date, count(*) as readings from ({c.TYPED_SQL}) group by date",
    "measure_float64": f"select state, {_types}, {', '.join(c.SQL_MEASURES)} from ({c.COERCED_SQL})",
    "stamp_ingested_at": f"""select state, cast(epoch(timestamp '2024-03-05 06:00:00') as bigint) as ingested_at_seconds,
      count(*) as readings from ({c.RENAMED_SQL}) group by state""",
    "hourly_to_daily": c.sql_round_all(c.ROLLED_SQL, c.SQL_MEASURES),
    "frame_profile": f"""select count(*) as "rows", min(date) as min_date, max(date) as max_date,
      '{_columns}' as columns from ({c.ROLLED_SQL})""",
    "head_sample": c.sql_round_all(
        f"select * from ({c.ROLLED_SQL}) order by {', '.join(k + ' nulls last' for k in c.SQL_KEYS)} limit 5", c.SQL_MEASURES
    ),
}
