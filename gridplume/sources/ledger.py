"""The ledger: one row per attempt at a chunk.

Layout: ``entry=<n>`` for each run or streamed batch, and beside it ``<ledger>-base/upto=<n>`` with all entries up to one.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridplume.schemas import CHUNK, LEDGER
from gridplume.session import delete_path, glob_paths


def _numbered(spark: SparkSession, pattern: str) -> dict[int, str]:
    return {int(p.rsplit("=", 1)[1]): p for p in glob_paths(spark, pattern)}


def _base(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """The last entry that the newest whole base holds, and its folder."""
    done = glob_paths(spark, f"{path}-base/upto=*/_SUCCESS")
    bases = {int(p.split("/upto=")[-1].split("/")[0]): p.removesuffix("/_SUCCESS") for p in done}
    return max(bases.items(), default=(0, None))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All attempts; an empty table before the first run."""
    upto, base = _base(spark, path)
    new = [p for n, p in sorted(_numbered(spark, f"{path}/entry=*").items()) if n > upto]
    paths = [*([base] if base else []), *new]
    if not paths:
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(*paths)


def append_ledger(attempts: DataFrame, path: str) -> None:
    """Add the attempts of a run or a batch as an entry of their own."""
    spark = attempts.sparkSession
    last = max([_base(spark, path)[0], *_numbered(spark, f"{path}/entry=*")])
    attempts.select(*LEDGER.names).coalesce(1).write.mode("append").parquet(f"{path}/entry={last + 1}")


def compact_ledger(spark: SparkSession, path: str) -> None:
    """Fold all entries into one base. No attempt is lost: what ``run_summary`` tells of any run stays the same.

    Every run and every streamed batch adds an entry, so a ledger of years would be read from thousands of small files.
    Not to be called while a run writes. What a base replaces is deleted after it is whole; a call that dies is called
    again.
    """
    entries, (upto, _) = _numbered(spark, f"{path}/entry=*"), _base(spark, path)
    last = max(entries, default=0)
    if last > upto:
        rows = read_ledger(spark, path).hint("rebalance").sortWithinPartitions("run_ts", *CHUNK)
        rows.write.mode("overwrite").parquet(f"{path}-base/upto={last}")
        upto = last
    for n, folder in entries.items():
        if n <= upto:
            delete_path(spark, folder)
    for n, folder in _numbered(spark, f"{path}-base/upto=*").items():
        if n != upto:
            delete_path(spark, folder)


def fold_if_long(spark: SparkSession, path: str, entries: int = 64) -> None:
    """``compact_ledger`` once that many entries have gathered; the runs call it when they have ended."""
    if len(glob_paths(spark, f"{path}/entry=*")) >= entries:
        compact_ledger(spark, path)


def attempt_rows(chunks: DataFrame, landed: DataFrame, verdicts: DataFrame, run_ts: datetime) -> DataFrame:
    """What became of each chunk.

    ``failed``: nothing landed, or what landed is bad. ``empty``: files landed without a row. ``ok``: the rest.
    ``landed`` lists the chunks with files; ``verdicts`` has (state, year, month, rows, bad) per chunk with rows.
    """
    files = landed.select(*CHUNK).distinct().withColumn("has_files", F.lit(True))
    joined = chunks.join(files, CHUNK, "left").join(verdicts, CHUNK, "left")
    status = (
        F.when(F.col("has_files").isNull() | F.col("bad"), "failed").when(F.col("rows").isNull(), "empty").otherwise("ok")
    )
    rows = F.when(status == "ok", F.col("rows")).otherwise(F.lit(0)).cast("bigint")
    stamp = F.lit(run_ts).cast("timestamp")
    return joined.select("chunk_key", *CHUNK, status.alias("status"), rows.alias("rows"), stamp.alias("run_ts"))
