"""Exact deduplication by a stream with keyed state that never expires.

The rows to look at land as (digest, identifier, place of the content). A stateful stream takes in what has landed since
its last run: the state, on disk in RocksDB, holds for each digest the number of rows and the identifier and place of
the row that stays. The state is read back as a table. On hits, digests with more than one row, the full bytes are
compared; texts that share a digest and differ are told apart by the bytes themselves.

Everything is DataFrame work. Defined results: a null text counts as empty; of equal texts the largest identifier stays
(null is below all), and of equal identifiers the row at the last place; an empty table gives an empty result; columns
besides the two that are named are not looked at, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridplume.llm.common import located, settings
from gridplume.session import as_written, work_path

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Native memory is shared by all state partitions of an executor, however many there are.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    # A partition's store is open only while its task runs: an open one holds 4 MB of disk, whatever its size.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def normalised(text: Column) -> Column:
    """Lower-cases A-Z only; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())


def digest_of(text: Column, bits: int = 256) -> Column:
    """The first ``bits`` of the SHA-256 of a normalised text, as hex. Fewer than 256 serve to test collisions."""
    return F.substring(F.sha2(text.cast("binary"), 256), 1, bits // 4)


def land(docs: DataFrame, place: Column, id_col: str, text_col: str, path: str, bits: int = 256) -> DataFrame:
    """Appends what the stream takes in to the folder ``path``; returns all that it holds."""
    rows = docs.select(
        digest_of(normalised(docs[text_col]), bits).alias("digest"),
        docs[id_col].cast("long").alias("id"),
        place.alias("place"),
    )
    rows.write.mode("append").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def take_in(spark: SparkSession, landing: DataFrame, path: str, checkpoint: str, files_per_batch: int | None = None) -> DataFrame:
    """Runs the stream over what has landed since its last run, and returns the state of all runs.

    One row for each digest: digest, last (id and place of the row that stays), copies. Partial aggregation
    sends one row per digest and task to the state, so a hot digest stays small. A run that dies is run again
    and goes on from the checkpoint.
    """
    source = spark.readStream.schema(landing.schema)
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    keyed = (
        source.parquet(path)
        .groupBy("digest")
        .agg(F.max(F.struct("id", "place")).alias("last"), F.count(F.lit(1)).alias("copies"))
    )
    with settings(spark, _STATE):
        query = (
            keyed.writeStream.outputMode("update").format("noop")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        state = spark.read.format("statestore").load(checkpoint)
        last, copies = state.schema["value"].dataType.names
        return as_written(
            state.select(
                F.col("key.digest").alias("digest"), F.col(f"value.{last}").alias("last"), F.col(f"value.{copies}").alias("copies")
            ),
            "state",
        )


def collided(docs: DataFrame, text_col: str, state: DataFrame, bits: int = 256) -> DataFrame:
    """Checks full bytes on hits: the digests that stand for more than one text.

    Only rows whose digest has a copy are compared. Equal texts of a task combine before the shuffle, so
    a hot group of copies moves as one row per task.
    """
    hits = state.where("copies > 1").select(F.xxhash64("digest").alias("_hit")).distinct()
    text = normalised(docs[text_col])
    rows = docs.select(digest_of(text, bits).alias("digest"), text.alias("content"))
    texts = rows.join(hits, F.xxhash64("digest") == F.col("_hit"), "left_semi").groupBy("digest", "content").agg(F.count(F.lit(1)).alias("n"))
    return texts.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("digest")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 256) -> DataFrame:
    """One row for each row of ``docs``: id, place, digest, keep_id, group_size, kept."""
    spark = docs.sparkSession
    docs, place = located(docs)
    path = work_path(spark, "landing")
    landing = land(docs, place, id_col, text_col, path, bits)
    state = take_in(spark, landing, path, work_path(spark, "checkpoint"))
    clash = as_written(collided(docs, text_col, state, bits), "clash")
    keyed = state.withColumnRenamed("digest", "_digest")
    found = landing.join(keyed, F.col("digest") == F.col("_digest")).drop("_digest")
    if not clash.isEmpty():
        found = found.join(clash, "digest", "left_anti").unionByName(_by_bytes(docs, place, id_col, text_col, clash, bits))
    return found.select(
        "id", "place", "digest",
        F.col("last.id").alias("keep_id"),
        F.col("copies").cast("long").alias("group_size"),
        F.struct("id", "place").eqNullSafe(F.col("last")).alias("kept"),
    )


def _by_bytes(docs: DataFrame, place: Column, id_col: str, text_col: str, clash: DataFrame, bits: int) -> DataFrame:
    """The rows of digests that stand for several texts, classed by the whole text."""
    text = normalised(docs[text_col])
    rows = docs.select(
        digest_of(text, bits).alias("digest"), docs[id_col].cast("long").alias("id"), place.alias("place"), text.alias("content")
    ).join(clash, "digest", "left_semi")
    whole = rows.groupBy("digest", "content").agg(F.max(F.struct("id", "place")).alias("last"), F.count(F.lit(1)).alias("copies"))
    return rows.join(whole, ["digest", "content"]).select("digest", "id", "place", "last", "copies")

