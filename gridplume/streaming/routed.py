"""The daily roll-up of a stream of readings in which no reading is lost: each is accepted, rejected or late.

Each batch has an event-time bound: the newest date that earlier batches accepted, less the lateness. A good reading
before the bound is late. Late and bad readings are laid aside as they landed; the accepted ones are summed up to the
daily rows that the batch adds. Sums of batches add up, so nothing is held in memory between batches, and a unit that is
never heard of again costs nothing.

Layout below one root: ``added/batch=<n>`` has a batch's daily sums, ``aside/batch=<n>/verdict=<v>`` its late and
rejected readings, ``batches/batch=<n>`` its bound, its newest date and how many readings went where. That row is written
last: a batch without it does not count and will be repeated, and a repeated batch replaces its own folders.
``<root>/base/upto=<n>`` holds the daily rows and the batches up to one, once ``compact`` has folded them.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gridplume.functions import numbers
from gridplume.functions.dates import LOOKBACK_DAYS
from gridplume.operators.shaping import hourly_to_daily, shape_hourly
from gridplume.schemas import DAILY, DAILY_KEYS, MEASURES
from gridplume.session import delete_path, glob_paths
from gridplume.streaming.daily import landed_readings

VERDICTS = ["accepted", "rejected", "late"]
_BATCH = T.StructType(
    [T.StructField("batch", T.LongType()), T.StructField("bound", T.DateType()), T.StructField("newest", T.DateType())]
    + [T.StructField(v, T.LongType()) for v in VERDICTS]
)
# Ids are numbers until they are stored.
_DAILY = T.StructType([T.StructField(c, T.DoubleType() if c == "facility_id" else DAILY[c].dataType) for c in [*DAILY_KEYS, *MEASURES]])
_ASIDE = T.StructType([*_DAILY.fields, T.StructField("verdict", T.StringType())])


def _numbered(spark: SparkSession, pattern: str, key: str) -> dict[int, str]:
    return {int(p.split(f"/{key}=")[-1].split("/")[0]): p for p in glob_paths(spark, pattern)}


def _base(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """The last batch that the newest whole base holds, and its folder. Its batches are written last."""
    done = _numbered(spark, f"{root}/base/upto=*/batches/_SUCCESS", "upto")
    upto = max(done, default=-1)
    return upto, done[upto].removesuffix("/batches/_SUCCESS") if done else None


def batches(spark: SparkSession, root: str) -> DataFrame:
    """(batch, bound, newest, accepted, rejected, late) of all batches that ended, a row each."""
    upto, base = _base(spark, root)
    done = [p.removesuffix("/_SUCCESS") for n, p in sorted(_numbered(spark, f"{root}/batches/batch=*/_SUCCESS", "batch").items()) if n > upto]
    paths = [*([f"{base}/batches"] if base else []), *done]
    return spark.read.schema(_BATCH).parquet(*paths) if paths else spark.createDataFrame([], _BATCH)


def newest_date(spark: SparkSession, root: str, batch: int) -> date | None:
    """The newest date that batches before one have accepted; None if there is none."""
    return batches(spark, root).where(F.col("batch") < batch).agg(F.max("newest")).first()[0]


def apply_batch(readings: DataFrame, batch: int, root: str, newest: date | None, lateness_days: int = LOOKBACK_DAYS) -> date | None:
    """Route the readings of one batch, ``newest`` being the ``newest_date`` before it; returns the one after it.
    Repeating it leaves the same."""
    spark = readings.sparkSession
    bound = newest and newest - timedelta(days=lateness_days)
    late = F.lit(False) if bound is None else F.coalesce(F.col("date") < F.lit(bound), F.lit(False))
    verdict = F.when(F.col("bad"), "rejected").when(late, "late").otherwise("accepted")
    judged = shape_hourly(readings, audited=True).withColumn("verdict", verdict).drop("bad", "named")
    seen = Observation()
    is_accepted = F.col("verdict") == "accepted"
    counted = judged.observe(
        seen, F.max(F.when(is_accepted, F.col("date"))).alias("newest"), *[F.count_if(F.col("verdict") == v).alias(v) for v in VERDICTS]
    )
    counted.where(~is_accepted).write.mode("overwrite").partitionBy("verdict").parquet(f"{root}/aside/batch={batch}")
    added = hourly_to_daily(judged.where(is_accepted).drop("verdict")).select(*DAILY_KEYS, *MEASURES)
    added.write.mode("overwrite").parquet(f"{root}/added/batch={batch}")
    told = seen.get
    row = (batch, bound, told["newest"], *[told[v] for v in VERDICTS])
    spark.createDataFrame([row], _BATCH).coalesce(1).write.mode("overwrite").parquet(f"{root}/batches/batch={batch}")
    return max(filter(None, [newest, told["newest"]]), default=None)


def routed_stream(
    spark: SparkSession, landing: str, root: str, checkpoint: str, lateness_days: int = LOOKBACK_DAYS, max_files: int | None = None
) -> StreamingQuery:
    """Start a run over the readings landed since the last one, at most ``max_files`` files in a batch. The bound is read
    from the table once a run and carried from batch to batch."""
    newest: list[date | None] = []

    def apply(readings: DataFrame, batch: int) -> None:
        before = newest.pop() if newest else newest_date(spark, root, batch)
        newest.append(apply_batch(readings, batch, root, before, lateness_days))

    return (
        landed_readings(spark, landing, max_files)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_daily(
    spark: SparkSession, landing: str, root: str, checkpoint: str, lateness_days: int = LOOKBACK_DAYS, max_files: int | None = None
) -> Row:
    """One run to its end. Returns (accepted, rejected, late): how many readings of this run went where, from the rows
    that its batches left, however many these are."""
    before = batches(spark, root).agg(F.max("batch")).first()[0]
    routed_stream(spark, landing, root, checkpoint, lateness_days, max_files).awaitTermination()
    new = batches(spark, root).where(F.col("batch") > (-1 if before is None else before))
    return new.agg(*[F.coalesce(F.sum(v), F.lit(0)).cast("bigint").alias(v) for v in VERDICTS]).first()


def aside(spark: SparkSession, root: str, verdict: str) -> DataFrame:
    """The ``late`` or ``rejected`` readings of all batches that ended, typed, and otherwise as they landed."""
    done = batches(spark, root).select("batch")
    if not glob_paths(spark, f"{root}/aside/batch=*/verdict={verdict}"):
        return spark.createDataFrame([], _DAILY)
    rows = spark.read.schema(T.StructType([*_ASIDE.fields, _BATCH["batch"]])).parquet(f"{root}/aside")
    return rows.where(F.col("verdict") == verdict).join(done, "batch", "left_semi").select(*_DAILY.names)


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*DAILY_KEYS).agg(*[numbers.zero_if_null(F.sum(m)).alias(m) for m in MEASURES])


def daily_rows(spark: SparkSession, root: str, with_late: bool = False) -> DataFrame:
    """The daily rows of all batches that ended; ``with_late`` also adds what came late."""
    upto, base = _base(spark, root)
    done = {r.batch for r in batches(spark, root).where(F.col("batch") > upto).select("batch").collect()}
    added = [p for n, p in sorted(_numbered(spark, f"{root}/added/batch=*", "batch").items()) if n in done]
    paths = [*([f"{base}/added"] if base else []), *added]
    rows = spark.read.schema(_DAILY).parquet(*paths) if paths else spark.createDataFrame([], _DAILY)
    if with_late:
        rows = rows.unionByName(hourly_to_daily(aside(spark, root, "late")).select(*_DAILY.names))
    return _summed(rows)


def compact(spark: SparkSession, root: str) -> None:
    """Fold all batches that ended into one base, their daily sums and their rows; late and rejected readings stay.

    Not to be called while a run writes. What a base replaces is deleted after it is whole; a call that dies is called
    again.
    """
    upto, _ = _base(spark, root)
    last = batches(spark, root).agg(F.max("batch")).first()[0]
    if last is None:
        return
    if last > upto:
        daily_rows(spark, root).write.mode("overwrite").parquet(f"{root}/base/upto={last}/added")
        batches(spark, root).coalesce(1).write.mode("overwrite").parquet(f"{root}/base/upto={last}/batches")
    for pattern, key, gone in (("added/batch=*", "batch", last), ("batches/batch=*", "batch", last), ("base/upto=*", "upto", last - 1)):
        for n, path in _numbered(spark, f"{root}/{pattern}", key).items():
            if n <= gone:
                delete_path(spark, path)
