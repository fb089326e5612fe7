"""Projections of the shared test tables into this library's input shapes. Tests, benchmark and queries use them.

Each is one SQL text for Spark and for DuckDB. Words in capitals stand for what the two spell differently.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# Daily rows: NULL dates, facility ids, measures and fuels; mixed-case fuels.
CEMS_DAILY = """
select n.n_name as state, s.s_name as facility_name,
  case when l_orderkey % 97 = 0 then null else l_suppkey end as facility_id,
  cast(l_linenumber as STR) as unit_id,
  case when l_orderkey % 101 = 0 then null else cast(l_shipdate as date) end as date,
  case when l_orderkey % 7 = 0 then null else l_quantity end as gross_load_mw,
  l_discount as so2_mass_lbs,
  case when l_orderkey % 5 = 0 then null else l_extendedprice end as co2_mass_tons,
  l_tax as nox_mass_lbs, p_retailprice as heat_input_mmbtu,
  case p_partkey % 11 when 0 then 'Pipeline Natural Gas' when 1 then 'Coal' when 2 then 'Coal, Natural Gas'
    when 3 then 'Diesel Oil' when 4 then 'NUCLEAR' when 5 then 'solar' when 6 then 'Wind' when 7 then 'Biomass'
    when 8 then 'Hydro' when 9 then 'Wood' end as primary_fuel,
  p_type as unit_type
from lineitem join supplier s on l_suppkey = s_suppkey join nation n on s_nationkey = n_nationkey
  join part on l_partkey = p_partkey
"""

# Readings as landed: numbers as text, with junk, blanks, NaN and foreign number formats.
CEMS_HOURLY = """
select n.n_name as stateCode, c.c_name as facilityName, cast(e.user_id as STR) as facilityId,
  case when e.event_id % 2 = 0 then 'U1' else 'U2' end as unitId,
  cast(cast(e.ts as date) as STR) as date,
  case when e.event_id % 13 = 0 then 'abc' when e.event_id % 17 = 0 then '' when e.event_id % 19 = 0 then null
    when e.event_id % 23 = 0 then '7d' else cast(e.value as STR) end as grossLoad,
  case when e.event_id % 11 = 0 then '1,000' when e.event_id % 29 = 0 then null
    else cast(e.event_id % 100 as STR) end as so2Mass,
  case when e.event_id % 7 = 0 then 'NaN' else cast(e.user_id % 40 as STR) end as co2Mass,
  case when e.event_id % 3 = 0 then '1e3' when e.event_id % 5 = 0 then '0x10'
    else cast(e.event_id % 9 as STR) end as noxMass,
  concat(' ', cast(e.event_id % 50 as STR), ' ') as heatInput,
  case e.event_type when 'click' then 'Pipeline Natural Gas' when 'view' then 'Coal'
    when 'purchase' then 'Diesel Oil' when 'signup' then 'Wind' end as primaryFuelInfo,
  case when e.user_id % 4 = 0 then null else c.c_mktsegment end as unitType
from events e join customer c on e.user_id = c.c_custkey join nation n on c.c_nationkey = n.n_nationkey
"""

# Two snapshots of recent months. The second lacks some rows, as a corrected file would.
CEMS_SNAPSHOTS = """
select n_name as state, s_name as facility_name, l_suppkey as facility_id, cast(l_linenumber as STR) as unit_id,
  cast(l_shipdate as date) as date, l_quantity as gross_load_mw, l_discount as so2_mass_lbs,
  l_extendedprice as co2_mass_tons, l_tax as nox_mass_lbs, l_quantity as heat_input_mmbtu,
  'Coal' as primary_fuel, 'Boiler' as unit_type,
  cast(year(l_shipdate) as int) as year, cast(month(l_shipdate) as int) as month,
  EACH(case when l_shipdate >= timestamp '2001-06-01 00:00:00' and l_orderkey % 10 <> 0
    then LIST(1, 2) else LIST(1) end) as ver
from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
"""


def register(spark: SparkSession, sf_dir: str) -> None:
    for name, schema in TABLES.items():
        spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


_SPARK = {"STR": "string", "EACH": "explode", "LIST": "array"}
_DUCKDB = {"STR": "varchar", "EACH": "unnest", "LIST": "list_value"}


def _spell(sql: str, words: dict[str, str]) -> str:
    for word, spelling in words.items():
        sql = re.sub(rf"\b{word}\b", spelling, sql)
    return sql


def for_duckdb(sql: str) -> str:
    return _spell(sql, _DUCKDB)


def project(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    register(spark, sf_dir)
    return spark.sql(_spell(sql, _SPARK))


def land(readings: DataFrame, root: str, mode: str = "append") -> None:
    """Write readings as JSON lines into landing folders. ``readings`` has the 12 fields and the folder keys.
    Nulls are written out: a field that no record names counts as missing."""
    keys = [k for k in ["state", "year", "month", "snapshot"] if k in readings.columns]
    rows = readings.hint("rebalance", *[F.col(k) for k in keys])
    rows.write.partitionBy(*keys).mode(mode).option("ignoreNullFields", False).json(root)


def with_folders(readings: DataFrame) -> DataFrame:
    """Readings with the keys of the landing folder they belong to."""
    day = F.to_date("date")
    return readings.withColumns({"state": F.col("stateCode"), "year": F.year(day), "month": F.month(day)})
