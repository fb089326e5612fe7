from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridplume.functions import dates
from gridplume.operators import chunks
from gridplume.schemas import LEDGER
from gridplume.sources.ledger import append_ledger, attempt_rows, read_ledger
from tests.rows import as_set


def value(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "as_of, first, last, n",
    [
        (date(2026, 12, 4), date(2026, 9, 1), date(2026, 11, 1), 3),
        (date(2017, 5, 1), date(2017, 1, 1), date(2017, 4, 1), 4),
        (date(2016, 1, 30), date(2015, 11, 1), date(2015, 12, 1), 2),
    ],
)
def test_lookback(spark, as_of, first, last, n):
    months = value(spark, dates.lookback_months(F.lit(as_of)))
    assert (months[0], months[-1], len(months)) == (first, last, n)


def test_lookback_covers_two_to_four_months(spark):
    days = spark.range(0, 28 * 365).select(F.date_add(F.lit(date(2016, 1, 1)), F.col("id").cast("int")).alias("d"))
    counts = {r.n: r["count"] for r in days.groupBy(F.size(dates.lookback_months(F.col("d"))).alias("n")).count().collect()}
    assert set(counts) == {2, 3, 4}
    assert counts[3] > counts[2] > counts[4]


@pytest.mark.parametrize("year, month, last", [(2024, 2, 29), (2023, 2, 28), (2024, 12, 31)])
def test_month_bounds(spark, year, month, last):
    bounds = value(spark, dates.month_bounds(F.lit(year), F.lit(month)))
    assert tuple(bounds) == (date(year, month, 1), date(year, month, last))


def test_last_completed_and_clamp(spark):
    as_of = F.lit(date(2024, 1, 15))
    assert value(spark, dates.last_completed_month(as_of)) == date(2023, 12, 1)
    assert value(spark, dates.clamp_to_completed(F.lit(date(2024, 1, 14)), as_of)) == date(2023, 12, 1)
    assert value(spark, dates.clamp_to_completed(F.lit(date(2023, 11, 9)), as_of)) == date(2023, 11, 9)
    assert value(spark, dates.default_load_date(as_of)) == date(2024, 1, 14)


def test_names(spark):
    parts = [F.lit("TX"), F.lit(2024), F.lit(1)]
    assert value(spark, dates.chunk_key(*parts)) == "TX-2024-01"
    assert value(spark, dates.chunk_path(*parts)) == "state=TX/year=2024/month=01"


@pytest.mark.parametrize(
    "text, day",
    [
        ("2024-01-05", date(2024, 1, 5)), (" 2024-01-05 ", date(2024, 1, 5)), ("2024-01-05T03:00", date(2024, 1, 5)),
        ("2024-01-05 23:59:59", date(2024, 1, 5)), ("", None), ("NaT", None), ("nan", None), (None, None),
    ],
)
def test_dates_that_pass(spark, text, day):
    df = spark.createDataFrame([(text,)], "t string").withColumn("d", dates.try_date(F.col("t")))
    assert df.select(dates.strict_date(F.col("d"), F.col("t"))).first()[0] == day


@pytest.mark.parametrize("text", ["not-a-date", "2024-13-01", "2024-02-30", "2024-01-05 junk", "None"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_dates_that_fail(spark, setting, text, ansi):
    setting("spark.sql.ansi.enabled", ansi)
    df = spark.createDataFrame([(text,)], "t string").withColumn("d", dates.try_date(F.col("t")))
    with pytest.raises(Exception, match="not a date"):
        df.select(dates.strict_date(F.col("d"), F.col("t"))).collect()


def test_backfill_calendar_has_every_state_month(spark):
    calendar = chunks.backfill_calendar(spark, date(2026, 4, 10))
    assert calendar.count() == 6150 == calendar.distinct().count()
    assert calendar.agg(F.min("chunk_key"), F.max("chunk_key")).first()[:] == ("AK-2016-01", "WY-2026-03")
    assert "Join" not in calendar._jdf.queryExecution().toString()


def test_calendar_that_ends_before_it_starts_is_empty(spark):
    assert chunks.backfill_calendar(spark, date(2016, 1, 10)).isEmpty()


def test_finished_chunks_are_skipped_and_failed_ones_are_not(spark):
    calendar = chunks.chunk_calendar(chunks.states_frame(spark, ["TX"]), F.lit(date(2024, 1, 1)), F.lit(date(2024, 5, 1)))
    stamp = datetime(2024, 6, 1)
    entries = [
        ("TX-2024-01", "TX", 2024, 1, "ok", 3, stamp),
        ("TX-2024-02", "TX", 2024, 2, "empty", 0, stamp),
        ("TX-2024-03", "TX", 2024, 3, "failed", 0, stamp),
        ("TX-2024-04", "TX", 2024, 4, "failed", 0, stamp),
        ("TX-2024-04", "TX", 2024, 4, "ok", 5, stamp + timedelta(days=1)),
        ("AK-2010-01", "AK", 2010, 1, "ok", 7, stamp),
    ]
    ledger = spark.createDataFrame(entries, LEDGER)
    left = chunks.remaining_chunks(calendar, ledger)
    assert [r.chunk_key for r in left.orderBy("chunk_key").collect()] == ["TX-2024-03", "TX-2024-05"]
    summary = chunks.run_summary(calendar, ledger, stamp + timedelta(days=1)).first().asDict()
    assert summary == {
        "total": 5, "already_done": 2, "remaining": 3, "succeeded": 1, "empty": 0, "failed": 0, "rows": 5,
    }
    assert [r.chunk_key for r in chunks.failed_chunks(ledger, stamp).orderBy("chunk_key").collect()] == [
        "TX-2024-03", "TX-2024-04",
    ]


def test_ledger_round_trip(spark, path):
    place = path("ledger")
    assert read_ledger(spark, place).isEmpty()
    calendar = chunks.chunk_calendar(chunks.states_frame(spark, ["TX"]), F.lit(date(2024, 1, 1)), F.lit(date(2024, 4, 1)))
    landed = calendar.where("month <> 4")
    written = spark.createDataFrame(
        [("TX", 2024, 1, 10, False), ("TX", 2024, 3, 4, True)], "state string, year int, month int, rows long, bad boolean"
    )
    attempts = attempt_rows(calendar, landed, written, datetime(2024, 6, 1))
    for _ in range(2):
        append_ledger(attempts, place)
    statuses = read_ledger(spark, place).select("chunk_key", "status", "rows").distinct()
    assert as_set(statuses) == [
        ("TX-2024-01", "ok", 10), ("TX-2024-02", "empty", 0), ("TX-2024-03", "failed", 0), ("TX-2024-04", "failed", 0),
    ]
    assert read_ledger(spark, place).count() == 8
