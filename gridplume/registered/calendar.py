"""Months, chunks and the ledger."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridplume import fixtures as fx
from gridplume.functions import dates
from gridplume.operators import chunks
from gridplume.registered import common as c
from gridplume.sources import ledger as led

_FIRST_RUN, _SECOND_RUN = datetime(2024, 3, 4, 6), datetime(2024, 3, 5, 6)


def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx.register(spark, sf_dir)
    return spark.table("orders").select(F.to_date("o_orderdate").alias("as_of")).distinct()


def month_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = chunks.sorted_months(_order_days(spark, sf_dir).withColumnRenamed("as_of", "date"))
    return months.select("year", "month", dates.month_bounds(F.col("year"), F.col("month")).alias("b")).select(
        "year", "month", "b.*"
    )


def last_completed_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _order_days(spark, sf_dir)
    return days.withColumns(
        {
            "last_completed": dates.last_completed_month(F.col("as_of")),
            "clamped": dates.clamp_to_completed(F.date_sub("as_of", 10), F.col("as_of")),
        }
    )


def lookback_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _order_days(spark, sf_dir)
    return days.select("as_of", F.explode(dates.lookback_months(F.col("as_of"))).alias("month_start"))


def default_load_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_days(spark, sf_dir).withColumn("load_date", dates.default_load_date(F.col("as_of")))


def _row_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks that have dated rows, with their number."""
    rows = c.cems_daily(spark, sf_dir).where("date is not null")
    return rows.groupBy("state", "year", "month").agg(F.count(F.lit(1)).alias("rows"))


def chunk_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [F.col(n) for n in ["state", "year", "month"]]
    found = _row_chunks(spark, sf_dir)
    return found.select(dates.chunk_key(*parts).alias("chunk_key"), "rows")


def chunk_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [F.col(n) for n in ["state", "year", "month"]]
    found = _row_chunks(spark, sf_dir)
    return found.select(dates.chunk_path(*parts).alias("chunk_path"), "rows")


def chunk_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nations with all months between the first and the last shipping date."""
    fx.register(spark, sf_dir)
    states = spark.table("nation").select(F.col("n_name").alias("state"))
    first, last = spark.table("lineitem").agg(F.to_date(F.min("l_shipdate")), F.to_date(F.max("l_shipdate"))).first()
    return chunks.chunk_calendar(states, F.lit(first), F.lit(last))


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An attempt per chunk with rows: the earlier years by the first run, the later ones by the second."""
    rows = chunks.with_key(_row_chunks(spark, sf_dir)).join(_row_chunks(spark, sf_dir), ["state", "year", "month"])
    month = F.col("month") % 10
    status = F.when(month == 0, "failed").when(month == 9, "empty").otherwise("ok")
    stamp = F.when(F.col("year") < 1999, F.lit(_FIRST_RUN)).otherwise(F.lit(_SECOND_RUN)).cast("timestamp")
    return rows.withColumns({"status": status, "run_ts": stamp})


def remaining_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.remaining_chunks(chunk_calendar(spark, sf_dir), _ledger(spark, sf_dir))


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.run_summary(chunk_calendar(spark, sf_dir), _ledger(spark, sf_dir), _SECOND_RUN)


def failed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.failed_chunks(_ledger(spark, sf_dir), _SECOND_RUN)


def sorted_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.sorted_months(c.cems_daily(spark, sf_dir))


def empty_chunk_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statuses over the calendar, if files landed in every month but May, April's hold no row and February's are bad."""
    calendar = chunk_calendar(spark, sf_dir)
    judged = _row_chunks(spark, sf_dir).where("month <> 4").withColumn("bad", F.col("month") == 2)
    attempts = led.attempt_rows(calendar, calendar.where("month <> 5"), judged, _SECOND_RUN)
    return attempts.select("chunk_key", "status", "rows")


QUERIES = {
    "month_bounds": month_bounds,
    "last_completed_month": last_completed_month,
    "lookback_months": lookback_months,
    "default_load_date": default_load_date,
    "chunk_key": chunk_key,
    "chunk_path": chunk_path,
    "chunk_calendar": chunk_calendar,
    "remaining_chunks": remaining_chunks,
    "run_summary": run_summary,
    "failed_chunks": failed_chunks,
    "sorted_months": sorted_months,
    "empty_chunk_skip": empty_chunk_skip,
}

_days = "select distinct cast(o_orderdate as date) as as_of from orders"
_rows = f"""select state, year, month, count(*) as "rows" from ({c.sql_with_month(c.DAILY_SQL)})
  where date is not null group by state, year, month"""
_key = "format('{}-{}-{:02d}', state, year, month) as chunk_key"
_calendar = f"""select {_key}, state, year, month from (
  select state, cast(year(m) as int) as year, cast(month(m) as int) as month from (
    select n_name as state, unnest(generate_series(
      (select date_trunc('month', min(l_shipdate)) from lineitem),
      (select date_trunc('month', max(l_shipdate)) from lineitem), interval 1 month)) as m from nation))"""
_ledger_sql = f"""select {_key}, *, case when month % 10 = 0 then 'failed' when month % 10 = 9 then 'empty' else 'ok' end
  as status, year < 1999 as first_run from ({_rows})"""
_done = f"select chunk_key from ({_ledger_sql}) where status in ('ok', 'empty')"
ORACLE = {
    "month_bounds": f"""select distinct cast(year(as_of) as int) as year, cast(month(as_of) as int) as month,
      cast(date_trunc('month', as_of) as date) as first_day, last_day(as_of) as last_day from ({_days})""",
    "last_completed_month": f"""select as_of, cast(date_trunc('month', as_of) - interval 1 month as date) as last_completed,
      case when as_of - 10 >= date_trunc('month', as_of) then cast(date_trunc('month', as_of) - interval 1 month as date)
        else as_of - 10 end as clamped from ({_days})""",
    "lookback_months": f"""select as_of, cast(unnest(generate_series(date_trunc('month', as_of - 90),
      date_trunc('month', as_of) - interval 1 month, interval 1 month)) as date) as month_start from ({_days})""",
    "default_load_date": f"select as_of, as_of - 1 as load_date from ({_days})",
    "chunk_key": f'select {_key}, "rows" from ({_rows})',
    "chunk_path": f"""select format('state={{}}/year={{}}/month={{:02d}}', state, year, month) as chunk_path, "rows"
      from ({_rows})""",
    "chunk_calendar": _calendar,
    "remaining_chunks": f"select * from ({_calendar}) where chunk_key not in ({_done})",
    "run_summary": f"""select
      (select count(*) from ({_calendar})) as total,
      (select count(*) from ({_calendar}) where chunk_key in ({_done} and first_run)) as already_done,
      (select count(*) from ({_calendar}) where chunk_key not in ({_done} and first_run)) as remaining,
      count(*) filter (status = 'ok') as succeeded, count(*) filter (status = 'empty') as empty,
      count(*) filter (status = 'failed') as failed, cast(sum("rows") as bigint) as "rows"
      from ({_ledger_sql}) where not first_run""",
    "failed_chunks": f"select chunk_key, state, year, month from ({_ledger_sql}) where status = 'failed' and not first_run",
    "sorted_months": f"""select distinct year, month from ({c.sql_with_month(c.DAILY_SQL)})
      where date is not null""",
    "empty_chunk_skip": f"""select chunk_key, status, case when status = 'ok' then "rows" else 0 end as "rows" from (
      select k.chunk_key, r."rows", case when k.month in (5, 2) and (k.month = 5 or r."rows" is not null) then 'failed'
        when k.month = 4 or r."rows" is null then 'empty' else 'ok' end as status
      from ({_calendar}) k left join ({_rows}) r on k.state = r.state and k.year = r.year and k.month = r.month)""",
}
