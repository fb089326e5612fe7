"""Streams and whole runs, over readings landed as files."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridplume import fixtures as fx
from gridplume.plans import flows
from gridplume.registered import common as c
from gridplume.schemas import MEASURES, SOURCE_FIELDS
from gridplume.session import work_path
from gridplume.sources import lake
from gridplume.sources.ledger import read_ledger
from gridplume.streaming import routed
from gridplume.streaming.daily import daily_state, daily_stream
from gridplume.streaming.snapshots import snapshot_stream

_AS_OF = date(2024, 3, 5)


def _land_two(spark: SparkSession, sf_dir: str, root: str):
    """Land every reading as snapshot 1; then, as snapshot 2 of some states, the readings of units 'U1' alone."""
    readings = fx.with_folders(c.cems_hourly(spark, sf_dir))
    fx.land(readings.withColumn("snapshot", F.lit(1)), root)
    yield
    again = readings.where("unitId = 'U1' and facilityId % 2 = 0 and state <= 'NATION_2'")
    fx.land(again.withColumn("snapshot", F.lit(2)), root)
    yield


def _places(spark: SparkSession) -> flows.Places:
    return flows.Places.below(work_path(spark, "run"), "query_marts")


def _states(spark: SparkSession) -> list[str]:
    return [r.n_name for r in spark.table("nation").collect()]


def daily_stream_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings that arrive in two parts, by unit: every day is updated by the second one."""
    landing, updates, checkpoint = (work_path(spark, n) for n in ["landing", "updates", "checkpoint"])
    readings = c.cems_hourly(spark, sf_dir)
    for part in ["U2", "U1"]:
        readings.where(F.col("unitId") == part).write.mode("append").json(landing)
        daily_stream(spark, landing, updates, checkpoint).awaitTermination()
    state = daily_state(spark, updates).withColumn("facility_id", F.col("facility_id").cast("bigint"))
    return c.rounded(state, *MEASURES)


def snapshot_stream_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each landing is followed by a run of the stream; the raw table then holds the newest snapshots."""
    places, checkpoint = _places(spark), work_path(spark, "checkpoint")
    for _ in _land_two(spark, sf_dir, places.landing):
        snapshot_stream(spark, places, checkpoint, c.RUN_TS).awaitTermination()
    rows = spark.read.parquet(places.raw).drop("ingested_at", "year", "month")
    return c.rounded(rows, *MEASURES)


def stream_to_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each landing is followed by a run of the stream, which refreshes the marts; they then hold the newest snapshots."""
    places, checkpoint = _places(spark), work_path(spark, "checkpoint")
    for _ in _land_two(spark, sf_dir, places.landing):
        snapshot_stream(spark, places, checkpoint, c.RUN_TS, models=True).awaitTermination()
    return c.rounded(flows.read_marts(spark, places)["mart_emissions_by_fuel"].drop("year", "month"), *c.TOTAL_NAMES)


def late_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings land in two parts, the days from the 20th on before the others; readings of some facilities have no date
    that is one, and ten days of lateness are accepted. How many went where, and the late ones by day."""
    landing, root, checkpoint = (work_path(spark, n) for n in ["landing", "routed", "checkpoint"])
    date_text = F.when(F.col("facilityId") % 50 == 0, F.lit("no date")).otherwise(F.col("date"))
    readings = c.cems_hourly(spark, sf_dir)
    for part in [F.col("date") >= "2024-01-20", F.col("date") < "2024-01-20"]:
        readings.where(part).withColumn("date", date_text).write.mode("append").json(landing)
        routed.run_daily(spark, landing, root, checkpoint, lateness_days=10)
    tally = routed.batches(spark, root).select(F.explode(F.array(*[
        F.struct(F.lit(v).alias("verdict"), F.lit(None).cast("date").alias("date"), F.col(v).alias("readings")) for v in routed.VERDICTS
    ])).alias("t")).groupBy("t.verdict", "t.date").agg(F.sum("t.readings").alias("readings"), F.lit(None).cast("double").alias("gross_load_mw"))
    days = routed.aside(spark, root, "late").groupBy(F.lit("late").alias("verdict"), "date")
    late = days.agg(F.count(F.lit(1)).alias("readings"), F.sum("gross_load_mw").alias("gross_load_mw"))
    return c.rounded(tally.unionByName(late), "gross_load_mw")


def routed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily rows of a routed stream, with the late readings added to those that were in time."""
    landing, root, checkpoint = (work_path(spark, n) for n in ["landing", "routed", "checkpoint"])
    readings = c.cems_hourly(spark, sf_dir)
    for part in [F.col("date") >= "2024-01-20", F.col("date") < "2024-01-20"]:
        readings.where(part).write.mode("append").json(landing)
        routed.run_daily(spark, landing, root, checkpoint, lateness_days=10)
        routed.compact(spark, root)
    rows = routed.daily_rows(spark, root, with_late=True).withColumn("facility_id", F.col("facility_id").cast("bigint"))
    return c.rounded(rows, *MEASURES)


def historical_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two months for all nations: January has landed, February has not."""
    places = _places(spark)
    fx.land(fx.with_folders(c.cems_hourly(spark, sf_dir)), places.landing)
    return flows.backfill(spark, places, _AS_OF, c.RUN_TS, date(2024, 1, 1), _states(spark))


def daily_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily runs, the second after a re-submission; the marts show the newest snapshots."""
    places = _places(spark)
    for _ in _land_two(spark, sf_dir, places.landing):
        flows.daily_run(spark, places, _AS_OF, c.RUN_TS, _states(spark))
    return c.rounded(spark.table(places.mart("mart_emissions_by_fuel")).drop("year", "month"), *c.TOTAL_NAMES)


def corrupt_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading lands in its chunk's folder; the records of each tenth facility are cut short. How the ledger has the chunks."""
    places = _places(spark)
    readings = fx.with_folders(c.cems_hourly(spark, sf_dir))
    line = F.to_json(F.struct(*[F.col(f) for f in SOURCE_FIELDS]), {"ignoreNullFields": "false"})
    cut = F.when(F.col("facilityId").cast("bigint") % 100 == 0, F.substring(line, 1, 40)).otherwise(line)
    readings.select("state", "year", "month", cut.alias("value")).write.partitionBy("state", "year", "month").text(places.landing)
    flows.backfill(spark, places, _AS_OF, c.RUN_TS, date(2024, 1, 1), _states(spark))
    attempts = read_ledger(spark, places.ledger).where("month = 1").groupBy("status")
    return attempts.agg(F.count(F.lit(1)).alias("chunks"), F.sum("rows").alias("rows"))


def misplaced_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streamed load, after a landing in which some states' files hold a row of another state: those chunks fail, and no other
    chunk loses its rows."""
    places, checkpoint = _places(spark), work_path(spark, "checkpoint")
    readings = fx.with_folders(c.cems_hourly(spark, sf_dir))
    fx.land(readings.where("state <= 'NATION_2'").withColumn("snapshot", F.lit(1)), places.landing)
    snapshot_stream(spark, places, checkpoint, c.RUN_TS).awaitTermination()
    later = readings.where("state > 'NATION_2'")
    strays = later.where("facilityId % 10 = 0 and state > 'NATION_22'").withColumn("stateCode", F.lit("NATION_1"))
    fx.land(later.unionByName(strays).withColumn("snapshot", F.lit(1)), places.landing)
    snapshot_stream(spark, places, checkpoint, c.RUN_TS).awaitTermination()
    rows = lake.raw_scan_all(spark, places.lake)
    return c.rounded(rows.groupBy("state").agg(F.count(F.lit(1)).alias("rows"), F.sum("gross_load_mw").alias("gross_load_mw")), "gross_load_mw")


QUERIES = {
    "corrupt_chunks": corrupt_chunks,
    "misplaced_rows": misplaced_rows,
    "daily_stream": daily_stream_query,
    "snapshot_stream": snapshot_stream_query,
    "stream_to_marts": stream_to_marts,
    "late_readings": late_readings,
    "routed_stream": routed_stream,
    "historical_backfill": historical_backfill,
    "daily_refresh": daily_refresh,
}

_again = "unit_id = 'U1' and facility_id % 2 = 0 and state <= 'NATION_2'"
_newest = f"""select * from ({c.TYPED_SQL}) where {_again}
  or state not in (select distinct state from ({c.TYPED_SQL}) where {_again})"""
_newest_daily = c.sql_daily(_newest)
_cut = f"select distinct stateCode as state from ({c.HOURLY_SQL}) where cast(facilityId as bigint) % 100 = 0"
_strays = f"""select distinct stateCode as state from ({c.HOURLY_SQL})
  where cast(facilityId as bigint) % 10 = 0 and stateCode > 'NATION_22'"""
ORACLE = {
    "corrupt_chunks": f"""select status, count(*) as chunks, cast(sum("rows") as bigint) as "rows" from (
      select n_name, case when d.state is null or n_name in ({_cut}) then 'failed' else 'ok' end as status,
        case when d.state is null or n_name in ({_cut}) then 0 else "rows" end as "rows"
      from nation left join (select state, count(*) as "rows" from ({c.ROLLED_SQL}) group by state) d on n_name = d.state)
      group by status""",
    "misplaced_rows": f"""select state, count(*) as "rows", round(sum(gross_load_mw), 4) + 0.0 as gross_load_mw
      from ({c.ROLLED_SQL}) where state not in ({_strays}) group by state""",
    "daily_stream": c.sql_round_all(c.ROLLED_SQL, c.SQL_MEASURES),
    "snapshot_stream": c.sql_round_all(_newest_daily, c.SQL_MEASURES),
    "historical_backfill": f"""select (select count(*) * 2 from nation) as total, 0 as already_done,
      (select count(*) * 2 from nation) as remaining, count(distinct state) as succeeded, 0 as empty,
      (select count(*) * 2 from nation) - count(distinct state) as failed, count(*) as "rows" from ({c.ROLLED_SQL})""",
    "stream_to_marts": c.sql_round_all(c.sql_by_fuel(c.sql_int(c.sql_stg(_newest_daily))), c.SQL_TOTALS),
    "late_readings": f"""with judged as (
        select *, case when try_cast(facilityId as bigint) % 50 = 0 then 'rejected'
          when date < (select cast(cast(max(cast(date as date)) as date) - 10 as varchar) from ({c.HOURLY_SQL})
            where date >= '2024-01-20' and try_cast(facilityId as bigint) % 50 <> 0) and date < '2024-01-20' then 'late'
          else 'accepted' end as verdict
        from ({c.HOURLY_SQL}))
      select verdict, cast(null as date) as date, count(*) as readings, cast(null as double) as gross_load_mw
      from judged group by verdict
      union all
      select verdict, cast(date as date), count(*),
        round(sum(case when isnan(try_cast(grossLoad as double)) then null else try_cast(grossLoad as double) end), 4) + 0.0
      from judged where verdict = 'late' group by verdict, date""",
    "routed_stream": c.sql_round_all(c.ROLLED_SQL, c.SQL_MEASURES),
    "daily_refresh": c.sql_round_all(c.sql_by_fuel(c.sql_int(c.sql_stg(_newest_daily))), c.SQL_TOTALS),
}
