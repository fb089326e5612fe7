"""Models, marts and dashboard tiles."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridplume.functions.fuels import fuel_category as category
from gridplume.plans import flows, models, tiles
from gridplume.registered import common as c
from gridplume.schemas import MEASURES
from gridplume.session import as_written, work_path
from gridplume.sources import lake

_FIRST, _LAST = date(1997, 3, 15), date(1999, 8, 20)


def _model(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.source_ref(name, {"raw_cems_daily": c.cems_daily(spark, sf_dir)})


def stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _model("stg_cems_daily", spark, sf_dir).drop("ingested_at")


def over_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _model("mart_emissions_over_time", spark, sf_dir)


def by_fuel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _model("mart_emissions_by_fuel", spark, sf_dir)


def _totals(df: DataFrame) -> DataFrame:
    return c.rounded(df, *[t for t in c.TOTAL_NAMES if t in df.columns])


def cast_facility_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Halves occur on purpose: the cast rounds them away from zero."""
    raw = c.cems_daily(spark, sf_dir).withColumn("facility_id", F.col("facility_id") / 2.0)
    cast = models.cast_facility_id(raw)
    return cast.groupBy("facility_id").agg(F.count(F.lit(1)).alias("n"))


def cast_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = c.cems_daily(spark, sf_dir).withColumn("date", F.col("date").cast("timestamp_ntz"))
    return models.cast_date(raw).groupBy("date").agg(F.count(F.lit(1)).alias("n"))


def coalesce_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    zeroed = models.coalesce_zero(c.cems_daily(spark, sf_dir))
    return zeroed.select("state", "facility_name", "unit_id", "date", *MEASURES)


def required_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = models.required_filter(c.cems_daily(spark, sf_dir))
    return kept.groupBy("state", "date").agg(F.count(F.lit(1)).alias("n"), F.count("facility_id").alias("with_facility"))


def fuel_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = c.cems_daily(spark, sf_dir)
    return raw.groupBy("primary_fuel", category(F.col("primary_fuel")).alias("fuel_category")).count().withColumnRenamed(
        "count", "n"
    )


def model_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The views of both layers over a stored raw table."""
    raw = work_path(spark, "raw")
    lake.load_truncate(c.cems_daily(spark, sf_dir), raw)
    models.layer_views(spark, raw, "query")
    return spark.sql("""
        select s.primary_fuel, s.n, i.facility_days
        from (select primary_fuel, count(*) as n from query_staging.stg_cems_daily group by primary_fuel) s
        join (select primary_fuel, sum(facility_count) as facility_days from query_intermediate.int_cems_aggregated
          group by primary_fuel) i
        on s.primary_fuel <=> i.primary_fuel""")


def model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = "mart_emissions_over_time"
    models.model_table(over_time(spark, sf_dir), name, work_path(spark, name))
    return _totals(spark.table(name))


def int_cems_aggregated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _totals(_model("int_cems_aggregated", spark, sf_dir))


def _ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored intermediate rows, by ranges of facilities."""
    place = work_path(spark, "intermediate")
    flows.store_intermediate(c.cems_daily(spark, sf_dir), place)
    return spark.read.parquet(place)


def facility_count_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the stored intermediate rows alone."""
    return models.exact_facilities(_ranges(spark, sf_dir), ["date", "state"])


def facility_count_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facilities per month, state and fuel category, from the same rows: their sets are united, not their counts added."""
    rows = _ranges(spark, sf_dir).withColumn("fuel_category", category(F.col("primary_fuel")))
    return models.exact_facilities(rows, ["year", "month", "state", "fuel_category"])


def facility_count_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facilities per state that burned gas or coal between two dates, each counted once."""
    rows = tiles.date_range_filter(_ranges(spark, sf_dir), _FIRST, _LAST)
    return models.exact_facilities(rows.where(category(F.col("primary_fuel")).isin("Natural Gas", "Coal")), ["state"])


def intermediate_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored intermediate rows, added up over the ranges of facilities: the model itself."""
    return _totals(_ranges(spark, sf_dir).groupBy(*models.INT_KEYS).agg(*[F.sum(n).alias(n) for n in models.INT_SUMS]))


def source_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both marts resolved from stored intermediate rows, without the raw rows behind them, side by side."""
    known = {"int_cems_aggregated": as_written(_model("int_cems_aggregated", spark, sf_dir), "int")}
    fuels = models.source_ref("mart_emissions_by_fuel", known).groupBy("date", "state").agg(
        F.count("fuel_category").alias("fuels"), F.sum("facility_count").alias("facilities_by_fuel")
    )
    over_time = models.source_ref("mart_emissions_over_time", known).select("date", "state", "facility_count")
    return over_time.join(fuels, ["date", "state"])


QUERIES = {
    "source_ref": source_ref,
    "stg_project": stg,
    "cast_facility_id": cast_facility_id,
    "cast_date": cast_date,
    "coalesce_zero": coalesce_zero,
    "required_filter": required_filter,
    "fuel_category": fuel_category,
    "model_view": model_view,
    "model_table": model_table,
    "int_cems_aggregated": int_cems_aggregated,
    "mart_emissions_over_time": lambda s, d: _totals(over_time(s, d)),
    "mart_emissions_by_fuel": lambda s, d: _totals(by_fuel(s, d)),
    "facility_count_exact": facility_count_exact,
    "facility_count_by_month": facility_count_by_month,
    "facility_count_in_range": facility_count_in_range,
    "intermediate_stored": intermediate_stored,
    "date_range_filter": lambda s, d: _totals(tiles.date_range_filter(over_time(s, d), _FIRST, _LAST)),
    "year_of_date": lambda s, d: tiles.year_of_date(over_time(s, d)).groupBy("year").agg(F.count(F.lit(1)).alias("n")),
    "tile_daily_generation": lambda s, d: _totals(tiles.daily_generation(over_time(s, d))),
    "tile_daily_generation_by_state": lambda s, d: _totals(
        tiles.daily_generation_by_state(over_time(s, d), _FIRST, _LAST)
    ),
    "tile_yearly_fuel_mix": lambda s, d: _totals(tiles.yearly_fuel_mix(by_fuel(s, d))),
    "fuel_share": lambda s, d: c.rounded(_totals(tiles.fuel_share(by_fuel(s, d))), "share", digits=8),
}

_range = f"date between date '{_FIRST}' and date '{_LAST}'"
_gen = "round(sum(total_gross_load_mw), 4) + 0.0 as total_gross_load_mw"
_mix = f"""select cast(year(date) as int) as year, fuel_category, {_gen} from ({c.BY_FUEL_SQL})
  group by year(date), fuel_category"""
ORACLE = {
    "source_ref": f"""select o.date, o.state, o.facility_count, f.fuels, f.facilities_by_fuel from ({c.OVER_TIME_SQL}) o
      join (select date, state, count(*) as fuels, cast(sum(facility_count) as bigint) as facilities_by_fuel
        from ({c.BY_FUEL_SQL}) group by date, state) f on o.date = f.date and o.state = f.state""",
    "stg_project": c.STG_SQL,
    "cast_facility_id": f"""select cast(round(facility_id / 2.0) as bigint) as facility_id, count(*) as n
      from ({c.DAILY_SQL}) group by 1""",
    "cast_date": f"select cast(date as date) as date, count(*) as n from ({c.DAILY_SQL}) group by 1",
    "coalesce_zero": f"""select state, facility_name, unit_id, date,
      {", ".join(f"coalesce({m}, 0) as {m}" for m in c.SQL_MEASURES)} from ({c.DAILY_SQL})""",
    "required_filter": f"""select state, date, count(*) as n, count(facility_id) as with_facility
      from ({c.DAILY_SQL}) where date is not null and state is not null group by state, date""",
    "fuel_category": f"""select primary_fuel, {c.CATEGORY_SQL} as fuel_category, count(*) as n
      from ({c.DAILY_SQL}) group by all""",
    "model_view": f"""select s.primary_fuel, s.n, cast(i.facility_days as bigint) as facility_days
      from (select primary_fuel, count(*) as n from ({c.STG_SQL}) group by primary_fuel) s
      join (select primary_fuel, sum(facility_count) as facility_days from ({c.INT_SQL}) group by primary_fuel) i
      on s.primary_fuel is not distinct from i.primary_fuel""",
    "model_table": c.sql_round_all(c.OVER_TIME_SQL, c.SQL_TOTALS),
    "int_cems_aggregated": c.sql_round_all(c.INT_SQL, c.SQL_TOTALS),
    "mart_emissions_over_time": c.sql_round_all(c.OVER_TIME_SQL, c.SQL_TOTALS),
    "mart_emissions_by_fuel": c.sql_round_all(c.BY_FUEL_SQL, c.SQL_TOTALS),
    "facility_count_exact": f"""select date, state, count(distinct facility_id) as facility_count_exact
      from ({c.STG_SQL}) group by date, state""",
    "facility_count_by_month": f"""select cast(year(date) as int) as year, cast(month(date) as int) as month, state, {c.CATEGORY_SQL} as fuel_category,
      count(distinct facility_id) as facility_count_exact from ({c.STG_SQL}) group by all""",
    "facility_count_in_range": f"""select state, count(distinct facility_id) as facility_count_exact from ({c.STG_SQL})
      where {_range} and {c.CATEGORY_SQL} in ('Natural Gas', 'Coal') group by state""",
    "intermediate_stored": c.sql_round_all(c.INT_SQL, c.SQL_TOTALS),
    "date_range_filter": c.sql_round_all(f"select * from ({c.OVER_TIME_SQL}) where {_range}", c.SQL_TOTALS),
    "year_of_date": f"select cast(year(date) as int) as year, count(*) as n from ({c.OVER_TIME_SQL}) group by 1",
    "tile_daily_generation": f"select date, {_gen} from ({c.OVER_TIME_SQL}) group by date",
    "tile_daily_generation_by_state": f"""select date, state, {_gen} from ({c.OVER_TIME_SQL}) where {_range}
      group by date, state""",
    "tile_yearly_fuel_mix": _mix,
    "fuel_share": f"""select *, round(total_gross_load_mw / nullif(sum(total_gross_load_mw) over (partition by year), 0), 8)
      + 0.0 as share from ({_mix})""",
}
