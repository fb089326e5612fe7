"""The two runs: the historical backfill and the daily refresh."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from gridplume.functions.dates import chunk_path
from gridplume.operators import chunks as ch
from gridplume.operators import quality
from gridplume.operators.joins import semi_join
from gridplume.operators.shaping import ALL_NAMED, daily_rows
from gridplume.plans import models, published
from gridplume.schemas import CHUNK, MONTH_KEYS, STATES
from gridplume.session import as_written, delete_path, path_exists, work_folder
from gridplume.sources import lake
from gridplume.sources.landing import chunk_folders, hourly_scan, landed_files, missing_fields, month_folders, newest_snapshots
from gridplume.sources.ledger import append_ledger, attempt_rows, fold_if_long, read_ledger

# Stored intermediate rows that a task writes, about 4.5 KB each in memory.
_RANGE_ROWS = 50_000


@dataclass(frozen=True)
class Places:
    """Where a deployment keeps its tables. ``marts`` is the database of the marts' views; their rows lie in its own
    folder, or below ``mart_root``."""

    landing: str
    lake: str
    raw: str
    ledger: str
    intermediate: str
    marts: str
    landing_format: str = "json"
    mart_root: str | None = None

    def mart(self, name: str) -> str:
        return f"{self.marts}.{name}"

    def published(self, spark: SparkSession) -> str:
        """The folder below which the marts' versions and their manifest lie."""
        return self.mart_root or f"{spark.conf.get('spark.sql.warehouse.dir')}/{self.marts}-versions"

    @classmethod
    def below(cls, root: str, marts: str, landing_format: str = "json") -> Places:
        """All tables below one folder."""
        names = ["landing", "lake", "raw", "ledger", "intermediate"]
        return cls(*[f"{root}/{n}" for n in names], marts, landing_format, f"{root}/marts")


class BadChunks(ValueError):
    pass


def newest_readings(
    spark: SparkSession, places: Places, files: DataFrame, chunks: DataFrame, folders: Sequence[str] | None = None
) -> DataFrame:
    """The landed readings of some chunks, each chunk by its newest snapshot, for an audit. ``files`` lists what has
    landed, in ``folders`` if they are given."""
    newest = newest_snapshots(files, chunks)
    return hourly_scan(spark, places.landing, places.landing_format, chunks=newest, audited=True, folders=folders)


def verdicts(
    spark: SparkSession, places: Places, daily: DataFrame, files: DataFrame, folders: Sequence[str] | None = None
) -> DataFrame:
    """(state, year, month, rows, bad) of each chunk with rows. Bad: a record could not be read, a row has a bad date,
    an id out of range or belongs to another chunk, or no record names some source field.

    Only chunks in which a field never has a value are read again, to tell a missing field from nulls.
    """
    counts = as_written(
        daily.groupBy(F.col("chunk_state").alias("state"), "year", "month").agg(
            F.count(F.lit(1)).alias("rows"), F.sum("bad_rows").alias("bad_rows"), F.bit_or("named").alias("named")
        ),
        "counts",
    )
    judged = counts.select(*CHUNK, "rows", ((F.col("bad_rows") > 0) | (F.col("named") == 0)).alias("bad"))
    doubtful = counts.where((F.col("named") != ALL_NAMED) & (F.col("named") != 0))
    if doubtful.isEmpty():
        return judged
    newest = newest_snapshots(files, doubtful)
    missing = missing_fields(spark, places.landing, places.landing_format, newest, folders).select(*CHUNK).distinct()
    lacks = judged.join(missing.withColumn("lacks", F.lit(True)), CHUNK, "left")
    return lacks.select(*CHUNK, "rows", (F.col("bad") | F.coalesce("lacks", F.lit(False))).alias("bad"))


def take_in(
    spark: SparkSession, places: Places, chunks: DataFrame, run_ts: datetime, folders: Sequence[str] | None = None
) -> DataFrame:
    """Bring the newest snapshots of ``chunks`` into the lake, each chunk by itself; returns the attempts.

    A bad chunk, or one without a landed file, is entered in the ledger as failed and leaves no row; the others are
    written. The daily rows are written to the work folder once, because the verdict on a chunk needs all of its rows.
    The ledger comes last: a run that dies is repeated. Call it inside a ``work_folder``.
    """
    files = as_written(landed_files(spark, places.landing, folders), "files")
    daily = as_written(daily_rows(newest_readings(spark, places, files, chunks, folders), run_ts, audited=True), "daily")
    judged = verdicts(spark, places, daily, files, folders)
    attempts = as_written(attempt_rows(chunks, files, judged, run_ts), "attempts")
    failed = attempts.where(F.col("status") == "failed").withColumnRenamed("state", "chunk_state")
    lake.lake_write(semi_join(daily, failed, ["chunk_state", "year", "month"], anti=True), places.lake)
    append_ledger(attempts, places.ledger)
    return attempts


def backfill(
    spark: SparkSession,
    places: Places,
    as_of: date,
    run_ts: datetime,
    start: date = date(2016, 1, 1),
    states: Sequence[str] = STATES,
) -> DataFrame:
    """Bring every unfinished chunk from ``start`` on into the lake; returns the run's summary.

    All chunks run as one job; see ``take_in``. A failed chunk is tried again by the next run, which lists the folders of
    what is left only; while most is left, Spark lists the whole landing in parallel instead.
    """
    calendar = as_written(ch.backfill_calendar(spark, as_of, start, states), "calendar")
    with work_folder(spark, "backfill"):
        todo = as_written(ch.remaining_chunks(calendar, read_ledger(spark, places.ledger)), "todo")
        few = 2 * todo.count() < calendar.count()
        take_in(spark, places, todo, run_ts, chunk_folders(spark, places.landing, todo) if few else None)
    fold_if_long(spark, places.ledger)
    return ch.run_summary(calendar, read_ledger(spark, places.ledger), run_ts)


def load_all(spark: SparkSession, places: Places) -> DataFrame:
    """Rebuild the raw table from the whole lake; returns its row count."""
    lake.load_truncate(lake.raw_scan_all(spark, places.lake), places.raw, lake.stored_bytes(spark, places.lake))
    return lake.load_row_count(spark, places.raw)


def daily_run(
    spark: SparkSession,
    places: Places,
    as_of: date,
    run_ts: datetime,
    states: Sequence[str] = STATES,
    publish_first: bool = False,
) -> list[Row]:
    """Fetch the look-back months again, replace them in lake and raw table, rebuild the models.

    Returns (chunk_path, rows) of the chunks it loaded. The list is empty, and nothing is touched, when nothing has
    landed for those months. A state without new rows keeps its old lake files. A bad chunk stops the run before
    it writes. Of the landing only the look-back months are listed.
    """
    calendar = ch.lookback_calendar(spark, as_of, states)
    with work_folder(spark, "daily"):
        window = [(r.year, r.month) for r in calendar.select("year", "month").distinct().collect()]
        folders = month_folders(spark, places.landing, sorted(window))
        files = as_written(landed_files(spark, places.landing, folders), "files")
        readings = newest_readings(spark, places, files, calendar, folders)
        daily = as_written(daily_rows(readings, run_ts, audited=True), "daily")
        if not quality.upload_gate(daily):
            return []
        # At most one row per state and look-back month.
        judged = verdicts(spark, places, daily, files, folders).orderBy(*CHUNK)
        path = chunk_path(*[F.col(c) for c in CHUNK]).alias("chunk_path")
        chunks = judged.select(path, "rows", "bad").collect()
        bad = [c.chunk_path for c in chunks if c.bad]
        if bad:
            raise BadChunks(f"broken records, bad dates or ids, misplaced rows or missing fields: {', '.join(bad)}")
        lake.lake_write(daily, places.lake)
        months = as_written(daily.select(*MONTH_KEYS.names).distinct(), "months")
        changed = [tuple(r) for r in months.collect()]
        lake.load_replace(lake.raw_scan_months(spark, places.lake, months), places.raw, lake.stored_bytes(spark, places.lake, changed))
        refresh_models(spark, places, months, publish_first)
    return [Row(chunk_path=c.chunk_path, rows=c.rows) for c in chunks]


def refresh_models(
    spark: SparkSession,
    places: Places,
    months: DataFrame | None = None,
    publish_first: bool = False,
    batch: tuple[str, int] | None = None,
) -> DataFrame:
    """Rebuild both marts, or some months of them, and run the data tests; returns the test report, or raises on a
    failing test.

    The intermediate rows and the marts are stored by month. All models group by date, so only ``months`` are read,
    recomputed and written; without them everything is. The staging tests are counted inside the same aggregate and
    stored beside it, so the raw rows are read once.

    New months of both marts are written beside the published ones and tested there; then one switch publishes them all,
    see ``published``, together with the ``batch`` that they come from. ``publish_first`` does that before the tests.
    """
    first_time = months is None or not path_exists(spark, places.intermediate)
    raw = lake.raw_table(spark, places.raw) if first_time else lake.raw_scan_months(spark, places.raw, months)
    touched = None if first_time else sorted((r.year, r.month) for r in months.select("year", "month").distinct().collect())
    store_intermediate(raw, places.intermediate, touched)
    stored = intermediate(spark, places)
    fresh = stored if first_time else stored.where(lake.month_predicate(touched))
    version, root = published.new_version(), places.published(spark)
    staged = {
        name: models.stage_mart(models.source_ref(name, {"int_cems_aggregated": fresh}), published.folder(root, name, version))
        for name in models.MARTS
    }

    def publish() -> None:
        # At most a row per month and mart.
        held = {name: [tuple(r) for r in mart.select(*MONTH_KEYS.names).distinct().collect()] for name, mart in staged.items()}
        published.switch(spark, root, version, held, touched, batch)
        published.create_views(spark, root, places.marts, models.mart_schemas())

    with work_folder(spark, "models"):
        if publish_first:
            publish()
        # Ten rows: one per test.
        report = staging_report(stored).unionByName(quality.report(staged))
        results = spark.createDataFrame(report.collect(), report.schema)
        quality.quality_gate(results)
        if not publish_first:
            publish()
    return results


def read_marts(spark: SparkSession, places: Places) -> dict[str, DataFrame]:
    """Both published marts by name, of one publication: never one of an older and one of a newer."""
    return published.marts(spark, places.published(spark), models.mart_schemas())


def intermediate(spark: SparkSession, places: Places) -> DataFrame:
    """The stored intermediate rows, by ranges of facilities: see ``models.int_by_facility_range``."""
    return spark.read.schema(models.intermediate_schema(len(quality.RULES["stg_cems_daily"]))).parquet(places.intermediate)


def staging_report(stored: DataFrame) -> DataFrame:
    """The staging tests, from the failing rows counted beside the stored intermediate rows."""
    rules = quality.RULES["stg_cems_daily"]
    names = [f"failures_{i}" for i in range(len(rules))]
    return quality.as_report(stored.agg(*[F.sum(n).alias(n) for n in names]), "stg_cems_daily", rules)


def store_intermediate(raw: DataFrame, path: str, months: Sequence[tuple[int, int]] | None = None) -> None:
    """Intermediate rows by month and ranges of facilities, with the failing staging rows of each group counted.

    ``raw`` holds all rows, or those of ``months``, whose stored rows are replaced; a month that has none any more goes.
    A task sorts ``_RANGE_ROWS`` rows by month, about, which their bytes in a shuffle cannot bound: bitmaps pack well.
    """
    spark, keys = raw.sparkSession, MONTH_KEYS.names
    counts = quality.failure_counts(quality.RULES["stg_cems_daily"])
    rows = models.int_by_facility_range(models.stg_cems_daily(raw), counts)
    written = Observation()
    # At most a number per month.
    dated = rows.withColumns({"year": F.year("date"), "month": F.month("date")}).observe(
        written, F.count(F.lit(1)).alias("rows"), F.collect_set(F.col("year") * 100 + F.col("month")).alias("months")
    )
    with work_folder(spark, "intermediate"):
        made = as_written(dated, "ranges")
        files = max(1, -(-written.get["rows"] // _RANGE_ROWS))
        made.repartitionByRange(files, *keys, *models.INT_KEYS, "facility_range").write.partitionBy(*keys).mode("overwrite").option(
            "partitionOverwriteMode", "static" if months is None else "dynamic"
        ).parquet(path)
    for year, month in months or []:
        if year * 100 + month not in written.get["months"]:
            delete_path(spark, f"{path}/year={year}/month={month}")
