"""Which (state, year, month) chunks there are, which are done, and how a run went."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridplume.functions import dates
from gridplume.schemas import CHUNK, STATES

DONE = ["ok", "empty"]


def states_frame(spark: SparkSession, states: Sequence[str] = STATES) -> DataFrame:
    return spark.createDataFrame([(s,) for s in states], "state string")


def chunk_calendar(states: DataFrame, first: Column, last: Column) -> DataFrame:
    """Every state with every month from ``first`` to ``last``. The months are exploded per state; nothing joins."""
    every_month = dates.month_range(dates.month_start(first), dates.month_start(last))
    months = states.select("state", F.explode(every_month).alias("m"))
    return with_key(months.select("state", F.year("m").alias("year"), F.month("m").alias("month")))


def backfill_calendar(
    spark: SparkSession, as_of: date, start: date = date(2016, 1, 1), states: Sequence[str] = STATES
) -> DataFrame:
    """The calendar from ``start`` to the last month completed before ``as_of``."""
    return chunk_calendar(states_frame(spark, states), F.lit(start), dates.last_completed_month(F.lit(as_of)))


def lookback_calendar(spark: SparkSession, as_of: date, states: Sequence[str] = STATES) -> DataFrame:
    """The calendar of the months that a daily run fetches again."""
    first = F.date_sub(F.lit(as_of), dates.LOOKBACK_DAYS)
    return chunk_calendar(states_frame(spark, states), first, dates.last_completed_month(F.lit(as_of)))


def with_key(chunks: DataFrame) -> DataFrame:
    key = dates.chunk_key(F.col("state"), F.col("year"), F.col("month"))
    return chunks.select(key.alias("chunk_key"), *CHUNK)


def remaining_chunks(chunks: DataFrame, ledger: DataFrame) -> DataFrame:
    """Chunks without a finished attempt. A failed attempt leaves its chunk in."""
    done = ledger.where(F.col("status").isin(DONE)).select("chunk_key").distinct()
    return chunks.join(done, "chunk_key", "left_anti")


def sorted_months(days: DataFrame) -> DataFrame:
    """The distinct months of ``days.date``, in order."""
    return (
        days.where(F.col("date").isNotNull())
        .select(F.year("date").alias("year"), F.month("date").alias("month"))
        .distinct()
        .orderBy("year", "month")
    )


def run_summary(chunks: DataFrame, ledger: DataFrame, run_ts: datetime | Column) -> DataFrame:
    """One row on the run stamped ``run_ts``: chunks in the calendar, done before it, left to it, and what became of
    them.

    Finished chunks that are not in the calendar do not count as done, so ``remaining`` cannot drift.
    """
    stamp = (F.lit(run_ts) if isinstance(run_ts, datetime) else run_ts).cast("timestamp")
    before = ledger.where(F.col("run_ts") < stamp)
    status = F.col("status")
    attempts = ledger.where(F.col("run_ts") == stamp).agg(
        F.count_if(status == "ok").alias("succeeded"),
        F.count_if(status == "empty").alias("empty"),
        F.count_if(status == "failed").alias("failed"),
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows"),
    )
    done = before.where(status.isin(DONE)).select("chunk_key").distinct().withColumn("done", F.lit(1))
    totals = chunks.join(done, "chunk_key", "left").agg(
        F.count(F.lit(1)).alias("total"),
        F.count("done").alias("already_done"),
        F.count_if(F.col("done").isNull()).alias("remaining"),
    )
    # One row each; put side by side without a join.
    both = totals.unionByName(attempts, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def failed_chunks(ledger: DataFrame, run_ts: datetime | Column) -> DataFrame:
    """The chunks that the run stamped ``run_ts`` could not finish."""
    stamp = (F.lit(run_ts) if isinstance(run_ts, datetime) else run_ts).cast("timestamp")
    return ledger.where((F.col("run_ts") == stamp) & (F.col("status") == "failed")).select("chunk_key", *CHUNK)
