"""What the registered queries share: inputs, rounding, and the SQL of the models."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridplume import fixtures as fx
from gridplume.operators import shaping
from gridplume.schemas import MEASURES, TOTALS

RUN_TS = datetime(2024, 3, 5, 6, 0, tzinfo=timezone.utc)
TOTAL_NAMES = [f"total_{m}" for m in TOTALS]


# Fixed values, spelled here once more: the SQL must not take over a mistake of the library's own lists.
SQL_FIELDS = """stateCode, facilityName, facilityId, unitId, date, grossLoad, so2Mass, co2Mass, noxMass, heatInput,
  primaryFuelInfo, unitType"""
SQL_KEYS = ["state", "facility_name", "facility_id", "unit_id", "date", "primary_fuel", "unit_type"]
SQL_MEASURES = ["gross_load_mw", "so2_mass_lbs", "co2_mass_tons", "nox_mass_lbs", "heat_input_mmbtu"]
SQL_TOTALS = ["total_gross_load_mw", "total_co2_mass_tons", "total_so2_mass_lbs", "total_nox_mass_lbs", "total_heat_input_mmbtu"]
SQL_CATEGORIES = "'Natural Gas', 'Coal', 'Oil', 'Nuclear', 'Solar', 'Wind', 'Biomass', 'Hydro', 'Other'"


def cems_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows as the raw table holds them, with the month of their chunk."""
    rows = fx.project(spark, sf_dir, fx.CEMS_DAILY)
    return shaping.to_raw_rows(shaping.stamp_ingested_at(rows, RUN_TS))


def cems_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.project(spark, sf_dir, fx.CEMS_HOURLY)


def cems_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows of two snapshots; the stamp of a snapshot is a day of its own."""
    rows = fx.project(spark, sf_dir, fx.CEMS_SNAPSHOTS)
    stamp = F.timestamp_add("day", F.col("ver"), F.lit(RUN_TS).cast("timestamp"))
    return rows.withColumn("ingested_at", stamp)


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


def sql_rounded(columns: list[str], digits: int = 4) -> str:
    return ", ".join(f"round({c}, {digits}) + 0.0 as {c}" for c in columns)


def by_chunk(rows: DataFrame) -> DataFrame:
    """A digest of stored rows, per chunk: enough to notice a lost, doubled or misplaced row."""
    sums = [F.sum(m).alias(m) for m in MEASURES]
    keys = ["state", "year", "month"]
    ids = F.sum("facility_id").cast("bigint").alias("facility_ids")
    return rounded(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), ids, *sums), *MEASURES)


def sql_by_chunk(rows: str) -> str:
    sums = ", ".join(f"round(sum({m}), 4) + 0.0 as {m}" for m in SQL_MEASURES)
    return (
        f'select state, year, month, count(*) as "rows", cast(sum(facility_id) as bigint) as facility_ids, {sums} '
        f"from ({rows}) group by state, year, month"
    )


def sql_with_month(rows: str) -> str:
    return f"select *, cast(year(date) as int) as year, cast(month(date) as int) as month from ({rows})"


DAILY_SQL = fx.for_duckdb(fx.CEMS_DAILY)
HOURLY_SQL = fx.for_duckdb(fx.CEMS_HOURLY)
SNAPSHOTS_SQL = fx.for_duckdb(fx.CEMS_SNAPSHOTS)

RENAMED_SQL = f"""select stateCode as state, facilityName as facility_name, facilityId as facility_id, unitId as unit_id,
  date, grossLoad as gross_load_mw, so2Mass as so2_mass_lbs, co2Mass as co2_mass_tons, noxMass as nox_mass_lbs,
  heatInput as heat_input_mmbtu, primaryFuelInfo as primary_fuel, unitType as unit_type from ({HOURLY_SQL})"""


def _number(column: str) -> str:
    value = f"try_cast({column} as double)"
    return f"case when isnan({value}) then null else {value} end as {column}"


COERCED_SQL = f"""select state, facility_name, {_number("facility_id")}, unit_id, date,
  {", ".join(_number(m) for m in SQL_MEASURES)}, primary_fuel, unit_type from ({RENAMED_SQL})"""
TYPED_SQL = f"select * replace (cast(date as date) as date) from ({COERCED_SQL})"


def sql_daily(typed: str, extra: str = "") -> str:
    sums = ", ".join(f"coalesce(sum({m}), 0.0) as {m}" for m in SQL_MEASURES)
    return f"""select state, facility_name, cast(round(facility_id) as bigint) as facility_id, unit_id, date, {sums},
      primary_fuel, unit_type{extra} from ({typed})
      group by state, facility_name, facility_id, unit_id, date, primary_fuel, unit_type{extra}"""


ROLLED_SQL = sql_daily(TYPED_SQL)


def sql_stg(raw: str) -> str:
    zeros = ", ".join(f"coalesce({m}, 0) as {m}" for m in SQL_MEASURES)
    return f"""select state, facility_name, cast(facility_id as bigint) as facility_id, unit_id,
      cast(date as date) as date, primary_fuel, unit_type, {zeros} from ({raw})
      where date is not null and state is not null"""


def sql_int(stg: str) -> str:
    sums = ", ".join(f"sum({t.removeprefix('total_')}) as {t}" for t in SQL_TOTALS)
    return f"""select state, date, primary_fuel, count(distinct facility_id) as facility_count, {sums}
      from ({stg}) group by state, date, primary_fuel"""


_MART_SUMS = ", ".join(f"sum({c}) as {c}" for c in SQL_TOTALS) + ", cast(sum(facility_count) as bigint) as facility_count"


def sql_over_time(int_rows: str) -> str:
    return f"select date, state, {_MART_SUMS} from ({int_rows}) group by date, state"


CATEGORY_SQL = """case when lower(primary_fuel) like '%natural gas%' then 'Natural Gas'
  when lower(primary_fuel) like '%coal%' then 'Coal' when lower(primary_fuel) like '%oil%' then 'Oil'
  when lower(primary_fuel) like '%nuclear%' then 'Nuclear' when lower(primary_fuel) like '%solar%' then 'Solar'
  when lower(primary_fuel) like '%wind%' then 'Wind' when lower(primary_fuel) like '%biomass%' then 'Biomass'
  when lower(primary_fuel) like '%hydro%' then 'Hydro' else 'Other' end"""


def sql_by_fuel(int_rows: str) -> str:
    return f"""select date, state, fuel_category, {_MART_SUMS}
      from (select *, {CATEGORY_SQL} as fuel_category from ({int_rows})) group by date, state, fuel_category"""


STG_SQL = sql_stg(DAILY_SQL)
INT_SQL = sql_int(STG_SQL)
OVER_TIME_SQL = sql_over_time(INT_SQL)
BY_FUEL_SQL = sql_by_fuel(INT_SQL)


def sql_round_all(sql: str, columns: list[str]) -> str:
    changes = ", ".join(f"round({c}, 4) + 0.0 as {c}" for c in columns)
    return f"select * replace ({changes}) from ({sql})"
