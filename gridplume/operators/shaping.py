"""From landed readings to daily unit rows."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridplume.functions import dates, numbers
from gridplume.schemas import DAILY_KEYS, MEASURES, RAW, SOURCE_FIELDS

NUMERIC = ["facility_id", *MEASURES]

# The chunk that a landing folder stands for. Present only where the folders name it.
FOLDER = ["chunk_state", "chunk_year", "chunk_month"]

# All bits of ``named`` set; see ``audit``.
ALL_NAMED = 2 ** len(SOURCE_FIELDS) - 1


class MissingFields(ValueError):
    pass


def _folder(df: DataFrame) -> list[str]:
    return [name for name in FOLDER if name in df.columns]


def _marks(df: DataFrame) -> list[str]:
    """The mark of records that could not be read, where an audited scan has set it."""
    return [name for name in ["corrupt"] if name in df.columns]


def select_rename(df: DataFrame) -> DataFrame:
    """Keep the 12 source fields under their daily names; a missing field is an error."""
    missing = [field for field in SOURCE_FIELDS if field not in df.columns]
    if missing:
        raise MissingFields(f"source fields missing: {', '.join(missing)}")
    return df.select(*[F.col(f).alias(name) for f, name in SOURCE_FIELDS.items()], *_folder(df), *_marks(df))


def coerce_numeric(df: DataFrame) -> DataFrame:
    """Facility id and measures as numbers; what is no number becomes NULL."""
    # In two steps, so that each text is parsed once.
    found = df.withColumns({f"_{c}": numbers.parsed(F.col(c)) for c in NUMERIC})
    types = {c: df.schema[c].dataType for c in NUMERIC}
    kept = {c: numbers.plain(F.col(f"_{c}"), F.col(c), types[c]) for c in NUMERIC}
    return found.withColumns(kept).select(*df.columns)


def _with_day(df: DataFrame) -> DataFrame:
    return df.withColumn("_day", dates.try_date(F.col("date").cast("string")))


def parse_date(df: DataFrame) -> DataFrame:
    """``date`` as a date. Bad text fails the job."""
    day = dates.strict_date(F.col("_day"), F.col("date").cast("string"))
    return _with_day(df).withColumn("date", day).select(*df.columns)


def audit(df: DataFrame) -> DataFrame:
    """``date`` as a date, and two columns by which a whole chunk can be judged later.

    ``bad``: the record could not be read, the date is no date, or the row belongs to another chunk than its folder.
    ``named``: one bit per source field, set where the field has a value; a chunk in which a bit is never set may lack
    the field.
    """
    bits = [F.when(F.col(c).isNotNull(), 1 << i).otherwise(0) for i, c in enumerate(SOURCE_FIELDS.values())]
    bad = dates.is_bad_date(F.col("_day"), F.col("date").cast("string"))
    if _folder(df) == FOLDER:
        month = F.col("chunk_year") * 100 + F.col("chunk_month")
        elsewhere = (dates.month_number(F.col("_day")) != month) | (F.col("state") != F.col("chunk_state"))
        bad = bad | F.coalesce(elsewhere, F.lit(False))
    for mark in _marks(df):
        bad = bad | F.col(mark)
    marked = _with_day(df).withColumns({"bad": bad, "named": reduce(Column.__add__, bits)})
    return marked.withColumn("date", F.col("_day")).drop("_day", *_marks(df))


def audit_ids(df: DataFrame) -> DataFrame:
    """Marks rows whose facility id is a number that no BIGINT holds, infinity too."""
    return df.withColumn("bad", F.col("bad") | F.coalesce(~numbers.is_id(F.col("facility_id")), F.lit(False)))


def measure_float64(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in MEASURES})


def shape_hourly(df: DataFrame, audited: bool = False) -> DataFrame:
    """Landed readings, typed. With ``audited`` a bad row is marked, else it fails the job."""
    renamed = select_rename(df)
    typed = measure_float64(coerce_numeric(audit(renamed) if audited else parse_date(renamed)))
    return audit_ids(typed) if audited else typed


def hourly_to_daily(df: DataFrame) -> DataFrame:
    """Sum the measures per daily row. NULL keys form groups; a sum over nothing but NULL is 0.

    The sums combine on the map side, so a unit or a state with a large share of all readings
    sends one row per task and key into the shuffle.
    """
    sums = [numbers.zero_if_null(F.sum(c)).alias(c) for c in MEASURES]
    if "bad" in df.columns:
        sums += [F.count_if("bad").alias("bad_rows"), F.bit_or("named").alias("named")]
    daily = df.groupBy(*DAILY_KEYS, *_folder(df)).agg(*sums)
    return measure_float64(daily)


def stamp_ingested_at(df: DataFrame, run_ts: datetime) -> DataFrame:
    """One stamp for the whole run: a literal, so that a recomputed task writes the same value."""
    return df.withColumn("ingested_at", F.lit(run_ts).cast("timestamp"))


def to_raw_rows(df: DataFrame) -> DataFrame:
    """Daily rows in the stored schema. A row belongs to its chunk's month, else to its date's.
    What an audit needs stays beside it."""
    year, month = F.year("date"), F.month("date")
    if _folder(df):
        year, month = F.coalesce("chunk_year", year), F.coalesce("chunk_month", month)
    rows = df.withColumns({"facility_id": numbers.to_id(F.col("facility_id")), "year": year, "month": month})
    beside = [c for c in ["chunk_state", "bad_rows", "named"] if "named" in df.columns and c in df.columns]
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW], *beside)


def daily_rows(hourly: DataFrame, run_ts: datetime, audited: bool = False) -> DataFrame:
    """Landed readings to stored daily rows: shape, roll up, stamp."""
    daily = hourly_to_daily(shape_hourly(hourly, audited))
    return to_raw_rows(stamp_ingested_at(daily, run_ts))
