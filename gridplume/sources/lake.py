"""The daily lake, the raw table, and the loads between them. Both are partitioned Parquet."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridplume.operators.joins import semi_join
from gridplume.schemas import CHUNK, DAILY, MONTH_KEYS, RAW
from gridplume.session import as_written, path_exists

_CLUSTER = ["state", "facility_id", "date"]
_LAKE = T.StructType([*RAW.fields, T.StructField("stateless", T.BooleanType())])
# Bytes of a stored row, about, where no file tells.
_ROW_BYTES = 64
# Rows that a task sorts for one file at most, about 260 MB in memory: bytes of files tell little, as rows that resemble each
# other are stored in a few bytes and sorted in some hundred.
FILE_ROWS = 1_000_000
_SIZES = "state string, year int, month int, bytes bigint, rows bigint"


def lake_write(daily: DataFrame, root: str) -> None:
    """Write daily rows into ``state=/year=/month=MM``. Chunks in ``daily`` are replaced, all others kept.

    A row lies in the folder of the chunk it came from: ``chunk_state`` where an audit has left it, else its own state.
    A row without a state of its own says so in ``stateless``, as the folder cannot.

    Rebalancing sends a chunk to one task, so a small one is one file; adaptive execution splits a chunk
    that is larger than the advisory size, so no task ever holds a large one whole.
    """
    owner = F.coalesce("chunk_state", "state") if "chunk_state" in daily.columns else F.col("state")
    rows = daily.select(
        *[F.col(f.name).cast(f.dataType) for f in RAW if f.name != "state"], owner.alias("state"), F.col("state").isNull().alias("stateless")
    )
    padded = rows.withColumn("month", F.lpad(F.col("month").cast("string"), 2, "0"))
    (
        padded.hint("rebalance", *[F.col(c) for c in CHUNK])
        .sortWithinPartitions(*CHUNK, "facility_id", "date")
        .write.partitionBy(*CHUNK)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(root)
    )


def _stored(rows: DataFrame) -> DataFrame:
    """Rows of lake files in the stored schema, each with its own state."""
    state = F.when(~F.coalesce("stateless", F.lit(False)), F.col("state")).alias("state")
    return rows.select(*[state if f.name == "state" else F.col(f.name) for f in RAW])


def raw_scan_all(spark: SparkSession, root: str) -> DataFrame:
    """Every daily row of the lake."""
    return _stored(spark.read.schema(_LAKE).parquet(root))


def raw_scan_months(spark: SparkSession, root: str, months: Iterable[tuple[int, int]] | DataFrame) -> DataFrame:
    """The daily rows of some months, all states. Only their folders are read; a month without files gives no rows."""
    rows = raw_scan_all(spark, root)
    if isinstance(months, DataFrame):
        return semi_join(rows, months, ["year", "month"])
    return rows.where(month_predicate(months))


def raw_scan_paths(spark: SparkSession, root: str, paths: str | list[str]) -> DataFrame:
    """The daily rows of one or more files or folders of the lake."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return _stored(spark.read.schema(_LAKE).option("basePath", root).parquet(*paths))


def month_predicate(months: Iterable[tuple[int, int]]):
    """Partition filter for a list of (year, month)."""
    condition = F.lit(False)
    for year, month in months:
        condition = condition | ((F.col("year") == year) & (F.col("month") == month))
    return condition


def in_range(df: DataFrame, first: date | None, last: date | None) -> DataFrame:
    """Rows dated ``first`` to ``last``; None leaves an end open. Stored rows lie in the partition of their date's
    month, and a filter on the date alone prunes no folder, so the months are named beside it."""
    stored = set(MONTH_KEYS.names) <= set(df.columns)
    month = F.col("year") * 100 + F.col("month") if stored else None
    for bound, passes in ((first, Column.__ge__), (last, Column.__le__)):
        if bound is not None:
            df = df.where(passes(F.col("date"), F.lit(bound)))
            if stored:
                df = df.where(passes(month, F.lit(bound.year * 100 + bound.month)))
    return df


def stored_bytes(spark: SparkSession, root: str, months: Iterable[tuple[int, int]] | None = None) -> DataFrame:
    """(state, year, month, bytes, rows) of the lake's files, or of those of some months. Lists, and reads footers; reads
    no content."""
    if not path_exists(spark, root):
        return spark.createDataFrame([], _SIZES)
    chosen = F.lit(True) if months is None else month_predicate(months)
    files = spark.read.format("binaryFile").load(root).where(chosen)
    footers = spark.read.schema(_LAKE).parquet(root).where(chosen)
    lengths = files.select(F.col("state").cast("string").alias("state"), "year", "month", F.col("length").alias("bytes"), F.lit(0).alias("rows"))
    counts = footers.groupBy(*CHUNK).agg(F.lit(0).alias("bytes"), F.count(F.lit(1)).alias("rows"))
    return lengths.unionByName(counts).groupBy(*CHUNK).agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))


def file_plan(sizes: DataFrame, file_bytes: int) -> DataFrame:
    """(state, year, month, first, files): which files of ``file_bytes`` or ``FILE_ROWS``, about, the rows of a chunk go to;
    by bytes alone where the sizes name no ``rows``.

    A month's files are filled state by state in order, so a state that is larger than a file spans several and small
    ones share one. The row without a state stands for rows that name none: they are dealt to all files of their month.
    The plan has a row per chunk.
    """
    along = Window.partitionBy("year", "month").orderBy(F.col("state").asc_nulls_first())
    end = F.sum("bytes").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if "rows" in sizes.columns:
        # So many rows fill a file whatever their bytes.
        sizes = sizes.withColumn("bytes", F.greatest("bytes", F.ceil(F.col("rows") * (file_bytes / FILE_ROWS))))
    known = sizes.where("state is not null and bytes > 0")
    spans = known.withColumn("end", end).select(
        *CHUNK, F.floor((F.col("end") - F.col("bytes")) / file_bytes).alias("low"), F.floor((F.col("end") - 1) / file_bytes).alias("high")
    )
    months = sizes.select("year", "month").distinct().join(spans.groupBy("year", "month").agg((F.max("high") + 1).alias("files")), ["year", "month"], "left")
    # One row per month.
    before = Window.orderBy("year", "month").rowsBetween(Window.unboundedPreceding, -1)
    months = months.withColumn("files", F.coalesce("files", F.lit(1)).cast("int"))
    months = months.withColumn("first", F.coalesce(F.sum("files").over(before), F.lit(0)).cast("int"))
    stated = spans.join(months.select("year", "month", "first"), ["year", "month"]).select(
        *CHUNK, (F.col("first") + F.col("low")).cast("int").alias("first"), (F.col("high") - F.col("low") + 1).cast("int").alias("files")
    )
    return stated.unionByName(months.select(F.lit(None).cast("string").alias("state"), "year", "month", "first", "files"))


def raw_layout(rows: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Rows in the raw table's layout: by month, and in each month by state, facility and date.

    ``sizes``, as ``stored_bytes`` lists them, tells without a look at the rows into how many files a month goes, and
    which states each holds: a month of many files has few states in each, a large state spans several, and a reader
    skips files and row groups by their minimum and maximum. All runs name the sizes; rows that come from no files are
    counted, and dealt by ranges of the same columns. Either way a task sorts about ``FILE_ROWS`` rows at most.
    """
    months, order = MONTH_KEYS.names, [*MONTH_KEYS.names, *_CLUSTER]
    wanted = rows.select(*DAILY.names, *months)
    advisory = _bytes(rows.sparkSession.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
    if sizes is None:
        files = max(1, -(-rows.count() // min(FILE_ROWS, max(1, advisory // _ROW_BYTES))))
        return wanted.repartitionByRange(files, *order, "unit_id").sortWithinPartitions(*order)
    plan = as_written(file_plan(sizes, advisory), "files")
    count = plan.agg(F.max(F.col("first") + F.col("files"))).first()[0] or 1
    places = plan.select(*[F.col(c).alias(f"_{c}") for c in plan.columns])
    same = (F.col("year") == F.col("_year")) & (F.col("month") == F.col("_month")) & F.col("state").eqNullSafe(F.col("_state"))
    spread = F.pmod(F.xxhash64("facility_id", "unit_id", "date"), F.coalesce("_files", F.lit(1)))
    # A chunk that the sizes don't know goes to any file.
    file = F.coalesce(F.col("_first") + spread, F.pmod(F.xxhash64(*CHUNK), F.lit(count))).cast("int")
    placed = wanted.join(places, same, "left").select(*wanted.columns, file.alias("_file"))
    return placed.repartitionById(count, F.col("_file")).drop("_file").sortWithinPartitions(*order)


def _bytes(size: str) -> int:
    """A size as Spark settings spell it."""
    found = re.fullmatch(r"(\d+)\s*([kmgt]?)i?b?", size.strip().lower())
    return int(found[1]) * 1024 ** " kmgt".index(found[2] or " ")


def raw_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW).parquet(path)


def load_truncate(lake_rows: DataFrame, table: str, sizes: DataFrame | None = None) -> int:
    """Replace the whole raw table. Returns the rows written, as the other loads do. ``sizes``: see ``raw_layout``."""
    return _load(lake_rows, table, "overwrite", "static", sizes)


def load_append(lake_rows: DataFrame, table: str, sizes: DataFrame | None = None) -> int:
    """Add rows to the raw table. Loading a month twice doubles it; see ``load_replace``."""
    return _load(lake_rows, table, "append", "static", sizes)


def load_replace(lake_rows: DataFrame, table: str, sizes: DataFrame | None = None) -> int:
    """Replace the months that ``lake_rows`` holds and keep all others.

    ``lake_rows`` must hold those months whole and must come from the lake, never from the table that is
    being replaced. A month without rows in the lake keeps what the table has.
    """
    return _load(lake_rows, table, "overwrite", "dynamic", sizes)


def _load(lake_rows: DataFrame, table: str, mode: str, overwrite: str, sizes: DataFrame | None) -> int:
    written = Observation()
    rows = raw_layout(lake_rows, sizes).observe(written, F.count(F.lit(1)).alias("rows"))
    rows.write.partitionBy(*MONTH_KEYS.names).mode(mode).option("partitionOverwriteMode", overwrite).parquet(table)
    return written.get["rows"]


def load_row_count(spark: SparkSession, table: str) -> DataFrame:
    """Rows in the raw table. No column is asked for, so the scan reads only file footers."""
    return raw_table(spark, table).agg(F.count(F.lit(1)).alias("rows"))
