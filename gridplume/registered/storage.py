"""Lake, raw table and snapshots. Each query writes in the work folder and reads back what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridplume.operators import snapshots
from gridplume.registered import common as c
from gridplume.schemas import MEASURES
from gridplume.session import work_path
from gridplume.sources import lake

_MONTHS = [(1998, m) for m in range(1, 13)]
_RECENT = [(2001, m) for m in range(6, 13)]


def _lake(spark: SparkSession, rows: DataFrame) -> str:
    root = work_path(spark, "lake")
    lake.lake_write(rows, root)
    return root


def raw_scan_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _lake(spark, c.cems_daily(spark, sf_dir))
    return lake.raw_scan_all(spark, root).drop("ingested_at")


def raw_scan_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _lake(spark, c.cems_daily(spark, sf_dir))
    return c.by_chunk(lake.raw_scan_months(spark, root, _MONTHS))


def raw_scan_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every state folder, named one by one."""
    rows = c.cems_daily(spark, sf_dir)
    root = _lake(spark, rows)
    states = [r.state for r in lake.raw_scan_all(spark, root).select("state").distinct().collect()]
    return c.by_chunk(lake.raw_scan_paths(spark, root, [f"{root}/state={s}" for s in states]))


def lake_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first snapshot, then the second one over it: its chunks are replaced, the others kept."""
    rows = c.cems_snapshots(spark, sf_dir)
    root = _lake(spark, rows.where("ver = 1"))
    lake.lake_write(rows.where("ver = 2"), root)
    return c.by_chunk(lake.raw_scan_all(spark, root))


def load_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded twice; the second load leaves the table as the first one did."""
    root, table = _lake(spark, c.cems_daily(spark, sf_dir)), work_path(spark, "raw")
    for _ in range(2):
        lake.load_truncate(lake.raw_scan_all(spark, root), table)
    return c.by_chunk(lake.raw_table(spark, table))


def _two_loads(spark: SparkSession, sf_dir: str, second_load) -> str:
    """Raw table of the first snapshot, then the recent months of the lake loaded again after the second one."""
    rows = c.cems_snapshots(spark, sf_dir)
    root, table = _lake(spark, rows.where("ver = 1")), work_path(spark, "raw")
    lake.load_truncate(lake.raw_scan_all(spark, root), table)
    lake.lake_write(rows.where("ver = 2"), root)
    second_load(lake.raw_scan_months(spark, root, _RECENT), table, lake.stored_bytes(spark, root, _RECENT))
    return table


def load_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.by_chunk(lake.raw_table(spark, _two_loads(spark, sf_dir, lake.load_append)))


def load_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.by_chunk(lake.raw_table(spark, _two_loads(spark, sf_dir, lake.load_replace)))


def raw_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and states per month of the laid-out table, its files planned from the lake's bytes."""
    root, table = _lake(spark, c.cems_daily(spark, sf_dir)), work_path(spark, "raw")
    lake.load_truncate(lake.raw_scan_all(spark, root), table, lake.stored_bytes(spark, root))
    return lake.raw_table(spark, table).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("state").alias("states")
    )


def load_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, table = _lake(spark, c.cems_daily(spark, sf_dir)), work_path(spark, "raw")
    lake.load_truncate(lake.raw_scan_all(spark, root), table)
    return lake.load_row_count(spark, table)


def month_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = c.cems_daily(spark, sf_dir).where(lake.month_predicate([(1996, 2), (1997, 7), (2000, 12)]))
    return c.by_chunk(rows)


def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = snapshots.latest_snapshot(c.cems_snapshots(spark, sf_dir))
    return newest.select("state", "facility_id", "unit_id", "date", "year", "month", "ver", *MEASURES)


QUERIES = {
    "raw_scan_all": raw_scan_all,
    "raw_scan_months": raw_scan_months,
    "raw_scan_paths": raw_scan_paths,
    "lake_write": lake_write,
    "load_truncate": load_truncate,
    "load_append": load_append,
    "load_replace": load_replace,
    "raw_layout": raw_layout,
    "load_row_count": load_row_count,
    "month_predicate": month_predicate,
    "latest_snapshot": latest_snapshot,
}

_month = c.sql_with_month(c.DAILY_SQL)
_newest = f"""select * from (select *, max(ver) over (partition by state, year, month) as newest
  from ({c.SNAPSHOTS_SQL})) where ver = newest"""
_again = f"""select * from ({c.SNAPSHOTS_SQL}) where ver = 1 union all
  select * exclude (newest) from ({_newest}) where year = 2001 and month >= 6"""
ORACLE = {
    "raw_scan_all": _month,
    "raw_scan_months": c.sql_by_chunk(f"select * from ({_month}) where year = 1998"),
    "raw_scan_paths": c.sql_by_chunk(_month),
    "lake_write": c.sql_by_chunk(_newest),
    "load_truncate": c.sql_by_chunk(_month),
    "load_append": c.sql_by_chunk(_again),
    "load_replace": c.sql_by_chunk(_newest),
    "raw_layout": f"""select year, month, count(*) as "rows", count(distinct state) as states from ({_month})
      group by year, month""",
    "load_row_count": f'select count(*) as "rows" from ({c.DAILY_SQL})',
    "month_predicate": c.sql_by_chunk(
        f"select * from ({_month}) where (year, month) in ((1996, 2), (1997, 7), (2000, 12))"
    ),
    "latest_snapshot": f"""select state, facility_id, unit_id, date, year, month, ver, {", ".join(c.SQL_MEASURES)}
      from ({_newest})""",
}
