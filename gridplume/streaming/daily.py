"""Incremental hourly-to-daily roll-up of an append-only stream of readings, with a watermark: what is later is dropped.
``routed`` keeps it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gridplume.functions import numbers
from gridplume.functions.dates import LOOKBACK_DAYS
from gridplume.operators.shaping import shape_hourly
from gridplume.schemas import DAILY, DAILY_KEYS, HOURLY, MEASURES
from gridplume.session import delete_path, glob_paths

_KEYS = [k for k in DAILY_KEYS if k != "date"]
_BROKEN = "_corrupt_record"
# Ids are numbers until they are stored.
_UPDATE = T.StructType(
    [T.StructField(k, T.DoubleType() if k == "facility_id" else DAILY[k].dataType) for k in [*DAILY_KEYS, *MEASURES]]
    + [T.StructField("batch", T.LongType())]
)


def landed_readings(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    """The stream of readings, with ``corrupt`` true and no values where a record cannot be read; at most ``max_files``
    files in a batch."""
    schema = T.StructType([*HOURLY.fields, T.StructField(_BROKEN, T.StringType())])
    reader = spark.readStream.schema(schema)
    readings = (reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)).json(landing)
    return readings.select(*HOURLY.names, F.col(_BROKEN).isNotNull().alias("corrupt"))


def daily_updates(readings: DataFrame, lateness: str = f"{LOOKBACK_DAYS} days") -> DataFrame:
    """Running daily sums; readings up to ``lateness`` behind the newest one are accepted, bad ones are left out.

    Readings carry no hour and so no unique key: a re-submitted reading would add twice. Use
    ``snapshot_stream`` for sources that re-submit.
    """
    # A reading has no hour, so its event time is the start of its day and one value of it is one daily window.
    good = shape_hourly(readings, audited=True).where(~F.col("bad"))
    timed = good.withColumn("ts", F.col("date").cast("timestamp"))
    sums = [numbers.zero_if_null(F.sum(m)).alias(m) for m in MEASURES]
    daily = timed.withWatermark("ts", lateness).groupBy("ts", *_KEYS).agg(*sums)
    return daily.withColumn("date", F.col("ts").cast("date")).select(*DAILY_KEYS, *MEASURES)


def daily_stream(spark: SparkSession, landing: str, updates: str, checkpoint: str) -> StreamingQuery:
    """Start a run over the readings landed since the last one. Each batch writes the daily rows it changed,
    under its own number, so that a repeated batch replaces itself; ``daily_state`` reads the result."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id).cast("bigint")).write.partitionBy("batch").mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).parquet(updates)

    return (
        daily_updates(landed_readings(spark, landing))
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _base(updates: str) -> str:
    return f"{updates.rstrip('/')}-base"


def _newest_base(spark: SparkSession, updates: str) -> tuple[str, int] | None:
    """The newest base that was written to its end, and the last batch it holds."""
    done = glob_paths(spark, f"{_base(updates)}/upto=*/_SUCCESS")
    bases = [(p.removesuffix("/_SUCCESS"), int(p.split("/upto=")[-1].split("/")[0])) for p in done]
    return max(bases, key=lambda b: b[1], default=None)


def daily_state(spark: SparkSession, updates: str) -> DataFrame:
    """The daily rows as of the last batch: per key, the sums of the newest batch that changed it."""
    base = _newest_base(spark, updates)
    rows = spark.read.schema(_UPDATE).parquet(updates)
    if base:
        rows = rows.where(F.col("batch") > base[1]).unionByName(spark.read.schema(_UPDATE).parquet(base[0]))
    return rows.groupBy(*DAILY_KEYS).agg(*[F.max_by(m, "batch").alias(m) for m in MEASURES])


def compact_updates(spark: SparkSession, updates: str) -> None:
    """Fold all finished batches into one base, so that ``daily_state`` reads each key once and the log stays short.

    Not to be called while a run writes. What a base replaces is deleted after it is whole; a call that dies is called
    again.
    """
    batches = [int(p.split("/batch=")[-1]) for p in glob_paths(spark, f"{updates}/batch=*")]
    if not batches:
        return
    last, old = max(batches), _newest_base(spark, updates)
    if not old or last > old[1]:
        state = daily_state(spark, updates).withColumn("batch", F.lit(last).cast("bigint"))
        state.write.mode("overwrite").parquet(f"{_base(updates)}/upto={last}")
    for path in glob_paths(spark, f"{_base(updates)}/upto=*"):
        if int(path.split("/upto=")[-1]) < last:
            delete_path(spark, path)
    for batch in batches:
        delete_path(spark, f"{updates}/batch={batch}")
