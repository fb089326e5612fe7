"""Newly landed files drive the snapshot load, and with it the marts."""

from __future__ import annotations

from concurrent.futures import Future
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridplume.operators.chunks import with_key
from gridplume.plans import published
from gridplume.plans.flows import Places, refresh_models, take_in
from gridplume.schemas import CHUNK, MONTH_KEYS
from gridplume.session import as_written, work_folder
from gridplume.sources import lake
from gridplume.sources.landing import month_folders, touched_chunks
from gridplume.sources.ledger import fold_if_long


def refresh_chunks(spark: SparkSession, places: Places, touched: DataFrame, run_ts: datetime) -> list[tuple[int, int]]:
    """Rebuild the touched chunks from their newest snapshots, in the lake and in the raw table; returns the months that
    got new rows.

    A bad chunk is entered in the ledger as failed and keeps the rows it had; the next snapshot of it is tried again.
    """
    with work_folder(spark, "snapshots"):
        chunks = as_written(with_key(touched.where(F.col("year").isNotNull()).distinct()), "touched")
        months = chunks.select(*MONTH_KEYS.names).distinct()
        folders = month_folders(spark, places.landing, [tuple(r) for r in months.collect()])
        attempts = take_in(spark, places, chunks, run_ts, folders)
        good = attempts.where("status = 'ok'").select(*MONTH_KEYS.names).distinct()
        changed = sorted(tuple(r) for r in good.collect())
        if changed:
            lake.load_replace(lake.raw_scan_months(spark, places.lake, good), places.raw, lake.stored_bytes(spark, places.lake, changed))
    return changed


def snapshot_stream(
    spark: SparkSession, places: Places, checkpoint: str, run_ts: datetime | None = None, models: bool = False
) -> StreamingQuery:
    """Start a run over the files landed since the last one; it ends when they are done.

    A micro-batch only tells which chunks are touched. Their rows are read from the landing itself, so a snapshot
    that arrives in two batches ends up whole, and a repeated batch writes the same again.

    With ``models`` each batch also rebuilds the marts' months that it changed. The publication notes the batch, so a
    batch that Spark repeats after its marts were published does nothing at all. A failing data test ends the run before
    its marts are published; the batch is repeated by the next run, which reads the newest snapshots.
    """
    started: Future[str] = Future()

    def apply(batch: DataFrame, batch_id: int) -> None:
        stamp = run_ts or datetime.now(timezone.utc)
        apply_batch(batch.sparkSession, places, batch.select(*CHUNK), stamp, (started.result(), batch_id) if models else None)

    stream = touched_chunks(spark.readStream, places.landing)
    query = (
        stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    started.set_result(str(query.id))
    return query


def apply_batch(spark: SparkSession, places: Places, touched: DataFrame, run_ts: datetime, batch: tuple[str, int] | None) -> None:
    """One batch of ``snapshot_stream``: raw table, and if ``batch`` (stream, number) is named the marts, once."""
    root = places.published(spark)
    if batch and published.newest(spark, root).batches.get(batch[0], -1) >= batch[1]:
        return
    months = refresh_chunks(spark, places, touched, run_ts)
    if batch and months:
        refresh_models(spark, places, spark.createDataFrame(months, MONTH_KEYS), batch=batch)
    elif batch:
        published.switch(spark, root, published.new_version(), {}, [], batch)
    fold_if_long(spark, places.ledger)
