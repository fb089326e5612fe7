"""Data tests and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridplume.operators import quality
from gridplume.registered import common as c
from gridplume.registered.daily import rolled
from gridplume.registered.marts import by_fuel, over_time, stg
from gridplume.schemas import FUEL_LABELS, OTHER_FUEL


def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {
        "stg_cems_daily": stg(spark, sf_dir),
        "mart_emissions_over_time": over_time(spark, sf_dir),
        "mart_emissions_by_fuel": by_fuel(spark, sf_dir),
    }
    return quality.report(tables).where("test = 'not_null'")


def accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The categories, which pass, and the fuel texts they come from, which do not."""
    marts = quality.check(by_fuel(spark, sf_dir), "mart_emissions_by_fuel").where("test = 'accepted_values'")
    rule = quality.accepted_values("primary_fuel", [*FUEL_LABELS, OTHER_FUEL])
    return marts.unionByName(quality.check(stg(spark, sf_dir), "stg_cems_daily", [rule]))


def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stops a run, of all tests of the three tables: the input holds rows without a facility on purpose."""
    tables = {
        "stg_cems_daily": stg(spark, sf_dir),
        "mart_emissions_over_time": over_time(spark, sf_dir),
        "mart_emissions_by_fuel": by_fuel(spark, sf_dir),
    }
    results = quality.report(tables)
    try:
        quality.quality_gate(results)
        failed = []
    except quality.QualityError as error:
        failed = [tuple(r) for r in error.failed]
    return spark.createDataFrame(failed, results.schema)


def upload_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per state where there is something to load; none where there is not."""
    daily = rolled(spark, sf_dir)
    later = daily.where("date >= date '2030-01-01'")
    kept = [rows for rows in (daily, later) if quality.upload_gate(rows)]
    return kept[0].groupBy("state").agg(F.count(F.lit(1)).alias("rows")).withColumn("loads", F.lit(len(kept)))


QUERIES = {
    "not_null": not_null,
    "accepted_values": accepted_values,
    "quality_gate": quality_gate,
    "upload_gate": upload_gate,
}


def _line(table: str, sql: str, column: str, test: str, failing: str) -> str:
    return f"""select '{table}' as "table", '{column}' as "column", '{test}' as test,
      count(*) filter ({failing}) as failures from ({sql})"""


def _missing(table: str, sql: str, columns: list[str]) -> list[str]:
    return [_line(table, sql, column, "not_null", f"{column} is null") for column in columns]


_STG = _missing("stg_cems_daily", c.STG_SQL, ["state", "date", "facility_id", "unit_id"])
_MARTS = _missing("mart_emissions_over_time", c.OVER_TIME_SQL, ["date", "state"]) + _missing(
    "mart_emissions_by_fuel", c.BY_FUEL_SQL, ["date", "state", "fuel_category"]
)
_CATEGORY = _line(
    "mart_emissions_by_fuel", c.BY_FUEL_SQL, "fuel_category", "accepted_values", f"fuel_category not in ({c.SQL_CATEGORIES})"
)
ORACLE = {
    "not_null": " union all ".join(_STG + _MARTS),
    "accepted_values": " union all ".join(
        [
            _CATEGORY,
            _line("stg_cems_daily", c.STG_SQL, "primary_fuel", "accepted_values",
                  f"primary_fuel not in ({c.SQL_CATEGORIES})"),
        ]
    ),
    "quality_gate": f"select * from ({' union all '.join([*_STG, *_MARTS, _CATEGORY])}) where failures > 0",
    "upload_gate": f'select state, count(*) as "rows", 1 as loads from ({c.ROLLED_SQL}) group by state',
}
