"""The four models: staging -> intermediate -> two marts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridplume.functions import numbers
from gridplume.functions.fuels import fuel_category
from gridplume.schemas import MEASURES, MONTH_KEYS, TOTALS

_TOTAL_NAMES = [f"total_{m}" for m in TOTALS]

# The staging and the intermediate model as SQL expressions, for the DataFrame models and for the lasting views.
REQUIRED = "date is not null and state is not null"
STG_COLUMNS = ["state", "facility_name", "facility_id", "unit_id", "date", "primary_fuel", "unit_type", *MEASURES]
STAGED = {"date": "cast(date as date)", **{m: f"coalesce({m}, 0.0D)" for m in MEASURES}}
INT_KEYS = ["state", "date", "primary_fuel"]
INT_SUMS = {"facility_count": "count(distinct facility_id)", **{f"total_{m}": f"sum({m})" for m in TOTALS}}


def cast_facility_id(raw: DataFrame) -> DataFrame:
    return raw.withColumn("facility_id", numbers.to_id(F.col("facility_id")))


def cast_date(raw: DataFrame) -> DataFrame:
    return raw.withColumn("date", F.expr(STAGED["date"]))


def coalesce_zero(raw: DataFrame) -> DataFrame:
    return raw.withColumns({m: F.expr(STAGED[m]) for m in MEASURES})


def required_filter(raw: DataFrame) -> DataFrame:
    """Rows with a date and a state. Rows without facility or unit stay, for the data tests to find."""
    return raw.where(REQUIRED)


def stg_cems_daily(raw: DataFrame) -> DataFrame:
    """Raw daily rows, typed and cleaned."""
    cleaned = coalesce_zero(cast_date(cast_facility_id(required_filter(raw))))
    stamp = [c for c in ["ingested_at"] if c in raw.columns]
    return cleaned.select(*STG_COLUMNS, *stamp)


def int_cems_aggregated(stg: DataFrame) -> DataFrame:
    """Totals and distinct facilities by state, date and fuel text.

    Spark groups by (state, date, fuel, facility) first, with partial sums on the map side, and counts
    facilities after that: neither a large state-day nor a large facility reaches a task as raw rows.
    """
    return stg.groupBy(*INT_KEYS).agg(*[F.expr(sql).alias(c) for c, sql in INT_SUMS.items()])


def int_by_facility_range(stg: DataFrame, extra: Sequence[Column] = ()) -> DataFrame:
    """The intermediate rows parted by ranges of 32,768 facility numbers, each with the set of its facilities as a
    bitmap of 4 KB (``facilities``, ``facility_range``).

    Ranges share no facility. So ``facility_count`` adds up over ranges to that of ``int_cems_aggregated``, and bitmaps
    of a range that are united count each facility once, over whatever dates and fuels: see ``exact_facilities``. The
    facility itself is no key any more. ``extra`` are counts of staged rows.

    Sums combine by facility first, so a large one is a row per task when it moves. Bitmaps are made where all facilities
    of their range have come together, and are not moved or sorted here: a shuffle packs a sparse one to a few bytes, and
    the task that reads it holds 4 KB.
    """
    ranged = stg.withColumns({
        "facility_range": F.bitmap_bucket_number("facility_id"), "_position": F.bitmap_bit_position("facility_id"),
    })
    keys = [*INT_KEYS, "facility_range"]
    sums = [F.expr(sql).alias(c) for c, sql in INT_SUMS.items() if c != "facility_count"]
    facilities = ranged.groupBy(*keys, "_position").agg(*sums, *extra)
    added = [F.sum(c).alias(c) for c in facilities.columns if c not in [*keys, "_position"]]
    rows = facilities.repartition(*keys).groupBy(*keys).agg(F.bitmap_construct_agg("_position").alias("facilities"), *added)
    return rows.withColumn("facility_count", F.coalesce(F.bitmap_count("facilities"), F.lit(0)).cast("bigint"))


def exact_facilities(ranges: DataFrame, keys: Sequence[str], name: str = "facility_count_exact") -> DataFrame:
    """Extension: facilities per ``keys``, each counted once, from rows of ``int_by_facility_range``. Rows without a
    facility form groups and count none."""
    united = ranges.groupBy(*keys, "facility_range").agg(F.bitmap_count(F.bitmap_or_agg("facilities")).alias("n"))
    return united.groupBy(*keys).agg(F.coalesce(F.sum(F.when(F.col("facility_range").isNotNull(), F.col("n"))), F.lit(0)).cast("bigint").alias(name))


def _mart(int_rows: DataFrame, keys: list[str]) -> DataFrame:
    """Totals added up over fuel texts. ``facility_count`` is added up too, as the models define it:
    a plant that burns two fuels counts twice. ``facility_count_exact`` does not do so."""
    sums = [F.sum(c).alias(c) for c in [*_TOTAL_NAMES, "facility_count"]]
    return int_rows.groupBy(*keys).agg(*sums)


def mart_emissions_over_time(int_rows: DataFrame) -> DataFrame:
    return _mart(int_rows, ["date", "state"])


def mart_emissions_by_fuel(int_rows: DataFrame) -> DataFrame:
    labelled = int_rows.withColumn("fuel_category", fuel_category(F.col("primary_fuel")))
    return _mart(labelled, ["date", "state", "fuel_category"])


def facility_count_exact(stg: DataFrame) -> DataFrame:
    """Extension: facilities per date and state, each counted once, from staged rows. Where intermediate rows are stored,
    ``exact_facilities`` counts from them."""
    return stg.groupBy("date", "state").agg(F.count_distinct("facility_id").alias("facility_count_exact"))


# What each model reads, and how it is made from that.
MODELS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "stg_cems_daily": ("raw_cems_daily", stg_cems_daily),
    "int_cems_aggregated": ("stg_cems_daily", int_cems_aggregated),
    "mart_emissions_over_time": ("int_cems_aggregated", mart_emissions_over_time),
    "mart_emissions_by_fuel": ("int_cems_aggregated", mart_emissions_by_fuel),
}
MARTS = ["mart_emissions_over_time", "mart_emissions_by_fuel"]


def mart_schemas() -> dict[str, T.StructType]:
    """The columns of the marts as stored, without the month keys."""
    totals = [T.StructField(c, T.DoubleType()) for c in _TOTAL_NAMES] + [T.StructField("facility_count", T.LongType())]
    keys = [T.StructField("date", T.DateType()), T.StructField("state", T.StringType())]
    return {
        "mart_emissions_over_time": T.StructType(keys + totals),
        "mart_emissions_by_fuel": T.StructType([*keys, T.StructField("fuel_category", T.StringType()), *totals]),
    }


def intermediate_schema(tests: int) -> T.StructType:
    """The stored rows of ``int_by_facility_range``, with the failing rows of so many staging tests and the month keys."""
    columns = {"state": T.StringType(), "date": T.DateType(), "primary_fuel": T.StringType(), "facility_range": T.LongType()}
    columns |= {"facilities": T.BinaryType(), **{c: T.DoubleType() for c in _TOTAL_NAMES}}
    columns |= {**{f"failures_{i}": T.LongType() for i in range(tests)}, "facility_count": T.LongType()}
    return T.StructType([*(T.StructField(c, t) for c, t in columns.items()), *MONTH_KEYS.fields])


def source_ref(name: str, known: dict[str, DataFrame]) -> DataFrame:
    """A model by name, built on what ``known`` holds: the raw rows, or any model already at hand."""
    if name in known:
        return known[name]
    if name not in MODELS:
        raise KeyError(f"no model or source named {name}")
    upstream, build = MODELS[name]
    return build(source_ref(upstream, known))


def model_views(spark: SparkSession, raw: DataFrame) -> None:
    """Staging and intermediate models as temporary views, for SQL users."""
    stg = source_ref("stg_cems_daily", {"raw_cems_daily": raw})
    stg.createOrReplaceTempView("stg_cems_daily")
    int_cems_aggregated(stg).createOrReplaceTempView("int_cems_aggregated")


def layer_views(spark: SparkSession, raw_path: str, schema: str) -> None:
    """Staging and intermediate models as lasting views over the stored raw table, each layer in a schema of its own:
    ``<schema>_staging.stg_cems_daily`` and ``<schema>_intermediate.int_cems_aggregated``.

    A lasting view is SQL text; the text is that of the columns from which the models themselves are built.
    """
    stg, aggregated = f"{schema}_staging.stg_cems_daily", f"{schema}_intermediate.int_cems_aggregated"
    for name in (stg, aggregated):
        spark.sql(f"create database if not exists {name.split('.')[0]}")
    columns = ", ".join(f"{STAGED.get(c, c)} as {c}" for c in [*STG_COLUMNS, "ingested_at"])
    spark.sql(f"create or replace view {stg} as select {columns} from parquet.`{raw_path}` where {REQUIRED}")
    keys, sums = ", ".join(INT_KEYS), ", ".join(f"{sql} as {c}" for c, sql in INT_SUMS.items())
    spark.sql(f"create or replace view {aggregated} as select {keys}, {sums} from {stg} group by {keys}")


def stage_mart(mart: DataFrame, path: str) -> DataFrame:
    """A mart's rows as a new version, by month and sorted by date; returns what is written. Nobody reads it yet."""
    months = MONTH_KEYS.names
    dated = mart.withColumns({"year": F.year("date"), "month": F.month("date")})
    dated.hint("rebalance", *[F.col(c) for c in months]).sortWithinPartitions(*months, "date").write.partitionBy(*months).parquet(path)
    return mart.sparkSession.read.schema(dated.schema).parquet(path)


def model_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """A mart as a table, rebuilt whole; in the catalog's own folder, or in ``path``."""
    if "." in name:
        df.sparkSession.sql(f"create database if not exists {name.rsplit('.', 1)[0]}")
    writer = df.write.mode("overwrite")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
