"""Landed readings: the files that a fetch left, one folder per (state, year, month).

Layout: ``<root>/state=TX/year=2024/month=01/snapshot=<n>/*``. A re-fetch lands as a new snapshot; files never change.
A landing that is never fetched again may leave out the snapshot level, everywhere. A fetch without rows lands too, as
``[]`` or as one empty line: Spark does not list files of no length. A flat folder can be scanned as well: its rows
belong to the month of their date.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from datetime import date
from urllib.parse import urlparse
from urllib.request import url2pathname

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from gridplume.functions import dates
from gridplume.operators.joins import semi_join
from gridplume.operators.shaping import MissingFields
from gridplume.schemas import CHUNK, HOURLY, SOURCE_FIELDS
from gridplume.session import as_written, glob_paths, path_exists

FORMATS = ("json", "json_array", "parquet")

_FOLDERS = T.StructType(
    [
        T.StructField("state", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("snapshot", T.LongType()),
    ]
)
_FILE = T.StructType([T.StructField("path", T.StringType()), T.StructField("length", T.LongType())])
# What a stream of files tells; only the columns that are asked for are read.
_EVENT = T.StructType([
    _FILE["path"], T.StructField("modificationTime", T.TimestampType()), _FILE["length"], T.StructField("content", T.BinaryType()),
    *_FOLDERS.fields,
])
# Where a JSON reader leaves the text of a record that it cannot read.
_BROKEN = T.StructField("_corrupt_record", T.StringType())


class CorruptRecords(ValueError):
    pass


def landing_schema(broken: bool = False) -> T.StructType:
    return T.StructType([*HOURLY.fields, *_FOLDERS.fields, *([_BROKEN] if broken else [])])


def month_folders(spark: SparkSession, root: str, months: Iterable[tuple[int, int]]) -> list[str]:
    """The landing folders of some months, all states. Nothing of other years is listed."""
    return _folders(spark, root, {month: "*" for month in months})


def chunk_folders(spark: SparkSession, root: str, chunks: DataFrame) -> list[str]:
    """The landing folders of some (state, year, month); one look at the store for each month."""
    states = chunks.groupBy("year", "month").agg(F.array_sort(F.collect_set("state")).alias("states"))
    return _folders(spark, root, {(r.year, r.month): f"{{{','.join(r.states)}}}" for r in states.orderBy("year", "month").collect()})


def _folders(spark: SparkSession, root: str, states: dict[tuple[int, int], str]) -> list[str]:
    found = []
    for (year, month), state in states.items():
        spellings = ",".join(sorted({str(month), f"{month:02d}"}))
        found += glob_paths(spark, f"{root}/state={state}/year={year}/month={{{spellings}}}")
    return found


def landed_files(spark: SparkSession, root: str, folders: Sequence[str] | None = None) -> DataFrame:
    """(state, year, month, snapshot, path, length) of every landed file, or of those in some folders.
    Lists; reads no content."""
    if (folders is not None and not folders) or not path_exists(spark, root):
        return spark.createDataFrame([], T.StructType([*_FOLDERS.fields, *_FILE.fields]))
    files = spark.read.format("binaryFile").option("basePath", root).load(list(folders or [root]))
    return files.select(*_folder_columns(files), *_FILE.names)


def newest_snapshots(files: DataFrame, chunks: DataFrame) -> DataFrame:
    """(state, year, month, snapshot): the newest snapshot of each of ``chunks``, by the file list alone, so that
    a newest snapshot without a single row still supersedes the older ones."""
    return files.join(chunks, CHUNK, "left_semi").groupBy(*CHUNK).agg(F.max("snapshot").alias("snapshot"))


def hourly_scan(
    spark: SparkSession,
    root: str,
    fmt: str = "json",
    as_of: date | None = None,
    chunks: DataFrame | None = None,
    strict_fields: bool = False,
    audited: bool = False,
    folders: Sequence[str] | None = None,
) -> DataFrame:
    """All landed readings in one scan, with the folder's month as ``chunk_year``, ``chunk_month`` and ``snapshot``.

    ``as_of`` keeps months completed before that day; ``chunks`` keeps the listed (state, year, month), and of
    them the listed ``snapshot`` if there is such a column. Both reach the scan as partition filters. ``folders`` are
    all that is listed and read. A record that is no JSON object fails the job; with ``audited`` it is a row without
    values in which the column ``corrupt`` is true. ``strict_fields`` reads the chosen chunks once more to prove that
    each names all 12 fields.
    """
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    if (folders is not None and not folders) or not path_exists(spark, root):
        df = spark.createDataFrame([], T.StructType([*landing_schema().fields, T.StructField("corrupt", T.BooleanType())]))
        return _named(df, audited)

    def chosen(rows: DataFrame) -> DataFrame:
        if as_of is not None:
            last = dates.month_number(dates.last_completed_month(F.lit(as_of)))
            rows = rows.where(F.col("year") * 100 + F.col("month") <= last)
        return rows if chunks is None else _in_chunks(rows, chunks)

    if strict_fields:
        _refuse_missing_fields(spark, root, fmt, chosen, folders)
    if fmt == "json_array":
        return _named(_array_rows(spark, root, chosen, audited, folders), audited)
    reader = spark.read.option("basePath", root)
    if fmt == "json" and not audited:
        reader = reader.option("mode", "FAILFAST")
    return _named(chosen(read_landing(reader, root, fmt, folders, broken=audited)), audited)


def _named(df: DataFrame, audited: bool) -> DataFrame:
    if audited and "corrupt" not in df.columns:
        df = df.withColumn("corrupt", F.col(_BROKEN.name).isNotNull() if _BROKEN.name in df.columns else F.lit(False))
    return df.select(
        *SOURCE_FIELDS, F.col("state").alias("chunk_state"), F.col("year").alias("chunk_year"),
        F.col("month").alias("chunk_month"), "snapshot", *(["corrupt"] if audited else []),
    )


def _in_chunks(rows: DataFrame, chunks: DataFrame) -> DataFrame:
    keys = [k for k in _FOLDERS.names if k in chunks.columns]
    return semi_join(rows, chunks, keys, null_keys=["snapshot"])


def read_landing(
    reader: DataFrameReader | DataStreamReader, root: str, fmt: str, folders: Sequence[str] | None = None, broken: bool = False
) -> DataFrame:
    """Landed rows of a format that splits, with their folders' keys; ``broken`` adds the text of broken records."""
    paths = list(folders) if folders else root
    if fmt == "parquet":
        return reader.schema(landing_schema()).parquet(*([paths] if isinstance(paths, str) else paths))
    return reader.schema(landing_schema(broken)).json(paths)


def touched_chunks(reader: DataStreamReader, root: str) -> DataFrame:
    """(state, year, month) of what landed, a row for each file, whatever it holds. Lists; reads no content."""
    return reader.format("binaryFile").schema(_EVENT).load(root).select(*CHUNK)


def _array_rows(spark: SparkSession, root: str, chosen, audited: bool, folders: Sequence[str] | None) -> DataFrame:
    """The readings of JSON arrays, record by record: a file is split at closing braces, wherever it is cut for tasks.

    A file must open and close its array once; one that does not is corrupt as a whole and gives one row without
    values. In a file whose array is whole but in which such a record is no object (a brace in a text, a nested
    object), the records cannot be told apart this way: only those files are decoded whole.
    """
    pieces = spark.read.option("basePath", root).option("lineSep", "}").text(list(folders) if folders else root)
    pieces = pieces.select("value", *_folder_columns(pieces), F.col("_metadata.file_path").alias("file"))
    pieces = chosen(pieces)
    text = F.trim(F.regexp_replace("value", r"[\s\uFEFF]+", " "))
    schema = T.StructType([*HOURLY.fields, _BROKEN])
    record = F.from_json(F.concat(F.regexp_replace("value", r"^[\s\uFEFF]*[\[,]", ""), F.lit("}")), schema)
    parsed = pieces.select(*_FOLDERS.names, "file", text.alias("text"), record.alias("record"))
    marked = parsed.withColumns({
        "opens": F.col("text").startswith("["),
        "closes": F.col("text").isin("]", "[]", "[ ]"),
        "is_record": F.col("text").rlike(r"^[\[,] ?\{"),
    })
    broken = F.col("is_record") & (F.col("record").isNull() | F.col(f"record.{_BROKEN.name}").isNotNull())
    judged = marked.groupBy("file", *_FOLDERS.names).agg(
        F.count_if("opens").alias("opens"), F.count_if("closes").alias("closes"),
        F.count_if(broken | (~F.col("is_record") & ~F.col("closes") & (F.col("text") != ""))).alias("odd"),
    )
    whole = (F.col("opens") == 1) & (F.col("closes") == 1)
    doubtful = judged.where(~whole | (F.col("odd") > 0)).select("file", *_FOLDERS.names, whole.alias("whole"))
    doubtful = as_written(doubtful, "doubtful")
    cut, nested = doubtful.where("not whole"), doubtful.where("whole")
    if not audited:
        names = [r["file"] for r in cut.orderBy("file").limit(10).collect()]
        if names:
            raise CorruptRecords(f"not a whole JSON array: {', '.join(names)}")
    rows = marked.where("is_record").withColumn("corrupt", F.lit(False))
    if not doubtful.isEmpty():
        rows = semi_join(rows, doubtful, ["file"], anti=True)
    rows = rows.select("record.*", *_FOLDERS.names, "corrupt").drop(_BROKEN.name)
    marks = cut.select(*_FOLDERS.names, F.lit(True).alias("corrupt"))
    rows = rows.unionByName(marks, allowMissingColumns=True)
    return rows if nested.isEmpty() else rows.unionByName(_whole_arrays(spark, root, nested, audited, folders))


def _whole_arrays(spark: SparkSession, root: str, files: DataFrame, audited: bool, folders: Sequence[str] | None) -> DataFrame:
    """The readings of some files with JSON arrays, each decoded whole. Only the folders of such files are read."""
    texts = spark.read.option("basePath", root).text(list(folders) if folders else root, wholetext=True)
    texts = texts.select("value", *_folder_columns(texts), F.col("_metadata.file_path").alias("file"))
    keys = [k for k in CHUNK if k in texts.columns]
    texts = semi_join(semi_join(texts, files, keys, null_keys=keys), files, ["file"])
    found = texts.select(*_FOLDERS.names, F.from_json(F.regexp_replace("value", r"^\uFEFF", ""), T.ArrayType(HOURLY)).alias("records"))
    broken = F.col("records").isNull()
    if not audited:
        # A text that is no array fails the job, as it does where records are read one by one.
        broken = F.when(broken, F.raise_error(F.lit("not a JSON array"))).otherwise(F.lit(False))
    records = F.when(broken, F.array(F.lit(None).cast(HOURLY))).otherwise(F.col("records"))
    rows = found.select(*_FOLDERS.names, broken.alias("corrupt"), F.explode(records).alias("record"))
    return rows.select("record.*", *_FOLDERS.names, "corrupt")


def missing_fields(
    spark: SparkSession, root: str, fmt: str = "json", chunks: DataFrame | None = None, folders: Sequence[str] | None = None
) -> DataFrame:
    """(state, year, month, field): source fields that no record of a chunk names, not even with a null.
    ``chunks`` and ``folders`` as for ``hourly_scan``."""
    return _missing(spark, root, fmt, lambda rows: rows if chunks is None else _in_chunks(rows, chunks), folders)


def _missing(spark: SparkSession, root: str, fmt: str, chosen, folders: Sequence[str] | None) -> DataFrame:
    if fmt == "parquet":
        return _absent(_named_columns(spark, as_written(chosen(landed_files(spark, root, folders)), "files")))
    paths = list(folders) if folders else root
    text = spark.read.option("basePath", root).option("lineSep", "}" if fmt == "json_array" else "\n").text(paths)
    text = chosen(text.select(*_folder_columns(text), "value"))
    if fmt == "json_array":
        # What is behind the last brace closes the array and names nothing.
        value = F.concat(F.regexp_replace("value", r"^[\s\uFEFF]*[\[,]", ""), F.lit("}"))
        text = text.where(~F.col("value").rlike(r"^[\s\uFEFF]*(?:\[\s*)?\]?\s*$")).withColumn("value", value)
    records = text.where("trim(value) <> ''").select(*CHUNK, F.json_object_keys("value").alias("keys"))
    if fmt == "json_array":
        # A brace inside a record has cut it. Such chunks are few, and only theirs are decoded whole.
        odd = as_written(records.where("keys is null").select(*CHUNK).distinct(), "odd")
        if not odd.isEmpty():
            whole = spark.read.option("basePath", root).text(paths, wholetext=True)
            whole = semi_join(chosen(whole.select(*_folder_columns(whole), "value")), odd, CHUNK)
            decoded = whole.select(*CHUNK, F.explode(F.from_json("value", "array<map<string,string>>")).alias("record"))
            records = records.where("keys is not null").unionByName(decoded.select(*CHUNK, F.map_keys("record").alias("keys")))
    return _absent(records)


def _absent(records: DataFrame) -> DataFrame:
    """(state, year, month, field) of the source fields that no row of a chunk has among its ``keys``."""
    seen = records.groupBy(*CHUNK).agg(
        *[F.bool_or(F.array_contains("keys", field)).alias(f"has_{field}") for field in SOURCE_FIELDS]
    )
    absent = F.array(*[F.when(~F.coalesce(f"has_{field}", F.lit(False)), F.lit(field)) for field in SOURCE_FIELDS])
    return seen.select(*CHUNK, F.explode(F.array_compact(absent)).alias("field"))


def _named_columns(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(state, year, month, keys): the columns of each Parquet file, from footers that tasks read.

    Of files on a shared file system a task reads the footer only. Other stores are left to Spark's reader, which hands
    over the content of a file: these are files in which some field has no value at all.
    """
    local = files.where(F.col("path").startswith("file:/"))
    other = files.where(~F.col("path").startswith("file:/"))
    schema = T.StructType([*_FOLDERS.fields[:3], T.StructField("keys", T.ArrayType(T.StringType()))])
    named = local.select(*CHUNK, "path").mapInArrow(_footers, schema)
    if other.isEmpty():
        return named
    paths = [r.path for r in other.select("path").collect()]
    content = spark.read.format("binaryFile").load(paths).join(other.select(*CHUNK, F.col("path").alias("_path")), F.col("path") == F.col("_path"))
    return named.unionByName(content.select(*CHUNK, "content").mapInArrow(_footers, schema))


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        *keys, source = batch.columns
        names = [
            pq.read_schema(pa.BufferReader(s) if isinstance(s, bytes) else url2pathname(urlparse(s).path)).names for s in source.to_pylist()
        ]
        yield pa.RecordBatch.from_arrays([*keys, pa.array(names, pa.list_(pa.string()))], [*CHUNK, "keys"])


def _folder_columns(df: DataFrame) -> list[Column]:
    """The landing folder's keys, NULL where the landing has no such level."""
    return [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in _FOLDERS]


def _refuse_missing_fields(spark: SparkSession, root: str, fmt: str, chosen, folders: Sequence[str] | None) -> None:
    absent = [r.field for r in _missing(spark, root, fmt, chosen, folders).select("field").distinct().collect()]
    if absent:
        raise MissingFields(f"source fields missing: {', '.join(sorted(absent))}")
