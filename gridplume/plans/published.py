"""What is published of the marts: a manifest names, for every mart and month, the version whose folder holds it.

Layout below one root: ``<mart>/version=<v>/year=2024/month=1/*`` holds rows, ``manifest/v=<n>`` one row with all
entries. New rows are staged in folders that no manifest names. Then the next manifest is written whole under a hidden
name and renamed: that one step switches all months of all marts. Readers take the manifest with the greatest number, so
they see all of a publication or nothing of it, whenever it stops; what a stopped one has staged is never read, and
``drop_unused`` deletes it.

A manifest has a row per mart and month, so it passes through the driver. It also keeps the last batch of each stream
that drives the marts, which makes a batch and its publication one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gridplume.schemas import MONTH_KEYS
from gridplume.session import delete_path, glob_paths, path_exists, rename_path

_VERSION = T.StructType([T.StructField("version", T.StringType()), *MONTH_KEYS.fields])
_MANIFEST = "entries array<struct<mart: string, year: int, month: int, version: string>>, batches map<string, bigint>"


@dataclass(frozen=True)
class Published:
    """The content of a manifest: its number, the version of each (mart, year, month), the last batch of each stream."""

    number: int = 0
    versions: dict[tuple[str, int, int], str] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)


def new_version() -> str:
    # The letter keeps Spark from taking a version for a number.
    return f"v{uuid.uuid4().hex}"


def folder(root: str, mart: str, version: str) -> str:
    """Where a version of a mart is staged."""
    return f"{root}/{mart}/version={version}"


def _manifests(spark: SparkSession, root: str) -> dict[int, str]:
    return {int(p.rsplit("/v=", 1)[1]): p for p in glob_paths(spark, f"{root}/manifest/v=*")}


def newest(spark: SparkSession, root: str) -> Published:
    """What is published now; nothing before the first publication."""
    found = _manifests(spark, root)
    if not found:
        return Published()
    number = max(found)
    row = spark.read.schema(_MANIFEST).parquet(found[number]).first()
    return Published(number, {(e.mart, e.year, e.month): e.version for e in row.entries}, dict(row.batches))


def switch(
    spark: SparkSession,
    root: str,
    version: str,
    held: dict[str, Iterable[tuple[int, int]]],
    months: Iterable[tuple[int, int]] | None = None,
    batch: tuple[str, int] | None = None,
) -> Published:
    """Publish a staged version: ``held`` has the months that each mart has there. Returns the new content.

    Without ``months`` the version holds all there is; else only those months change, and a month that a mart does not
    hold any more vanishes. ``batch`` (stream, number) is noted with it. If another publication has come in between, its
    other months are kept.
    """
    changed = None if months is None else set(months)
    while True:
        old = newest(spark, root)
        kept = {} if changed is None else {key: v for key, v in old.versions.items() if key[1:] not in changed}
        new = Published(
            old.number + 1,
            {**kept, **{(mart, *month): version for mart, own in held.items() for month in own}},
            {**old.batches, **dict([batch] if batch else [])},
        )
        staged = f"{root}/manifest/.staged-{uuid.uuid4().hex}"
        row = ([(*key, v) for key, v in sorted(new.versions.items())], new.batches)
        spark.createDataFrame([row], _MANIFEST).coalesce(1).write.parquet(staged)
        if rename_path(spark, staged, f"{root}/manifest/v={new.number}"):
            return new
        delete_path(spark, staged)


def marts(spark: SparkSession, root: str, schemas: dict[str, T.StructType]) -> dict[str, DataFrame]:
    """The published marts, all of one manifest; ``schemas`` has the columns of each. Only their folders are listed, so
    a filter on year and month prunes when the query is planned."""
    now = newest(spark, root)
    found = {}
    for mart, schema in schemas.items():
        paths = [f"{folder(root, mart, v)}/year={y}/month={m}" for (name, y, m), v in sorted(now.versions.items()) if name == mart]
        columns = T.StructType([*schema.fields, *MONTH_KEYS.fields])
        if paths:
            stored = T.StructType([*schema.fields, *_VERSION.fields])
            found[mart] = spark.read.schema(stored).option("basePath", f"{root}/{mart}").parquet(*paths).select(*columns.names)
        else:
            found[mart] = spark.createDataFrame([], columns)
    return found


def create_views(spark: SparkSession, root: str, database: str, schemas: dict[str, T.StructType]) -> None:
    """The published marts as lasting views for SQL users, ``<database>.<mart>``.

    A view joins the stored rows with the newest manifest when it is queried, so it never has to change again. The
    manifest is small, is broadcast, and prunes the folders of other versions.
    """
    spark.sql(f"create database if not exists {database}")
    for mart, schema in schemas.items():
        name = f"{database}.{mart}"
        text = _view(root, mart, schema) if glob_paths(spark, f"{root}/{mart}/version=*/year=*/month=*/*") else _no_rows(schema)
        if spark.catalog.tableExists(name):
            shown = spark.sql(f"describe extended {name}").where("col_name in ('Type', 'View Text')").collect()
            if text in {r["data_type"] for r in shown}:
                continue
            if "VIEW" not in {r["data_type"] for r in shown}:
                spark.sql(f"drop table {name}")
        spark.sql(f"create or replace view {name} as {text}")


def _view(root: str, mart: str, schema: T.StructType) -> str:
    # One relation gives both the greatest number and its entries: a switch in between can't part them.
    entries = f"select explode(entries) as entry from (select max_by(entries, v) as entries from parquet.`{root}/manifest`)"
    columns = ", ".join([*(f"cast(d.`{f.name}` as {f.dataType.simpleString()}) as `{f.name}`" for f in schema), "d.year", "d.month"])
    return (
        f"select {columns} from parquet.`{root}/{mart}` d "
        f"join (select entry.version, entry.year, entry.month from ({entries}) where entry.mart = '{mart}') m "
        "on d.version = m.version and d.year = m.year and d.month = m.month"
    )


def _no_rows(schema: T.StructType) -> str:
    columns = [*schema.fields, *MONTH_KEYS.fields]
    return "select " + ", ".join(f"cast(null as {f.dataType.simpleString()}) as `{f.name}`" for f in columns) + " where false"


def drop_unused(spark: SparkSession, root: str) -> None:
    """Delete the month folders that the newest manifest does not name, older manifests, and what a stopped publication
    has left. Readers of older versions must be done, and nobody may be publishing."""
    now = newest(spark, root)
    used = {f"{mart}/version={v}/year={y}/month={m}" for (mart, y, m), v in now.versions.items()}
    for path in glob_paths(spark, f"{root}/*/version=*/year=*/month=*"):
        if "/".join(path.rsplit("/", 4)[1:]) not in used:
            delete_path(spark, path)
    kept = {"/".join(u.split("/")[:2]) for u in used}
    for path in glob_paths(spark, f"{root}/*/version=*"):
        if "/".join(path.rsplit("/", 2)[1:]) not in kept:
            delete_path(spark, path)
    for number, path in _manifests(spark, root).items():
        if number < now.number:
            delete_path(spark, path)
    for path in glob_paths(spark, f"{root}/manifest/.staged-*"):
        delete_path(spark, path)


def is_published(spark: SparkSession, root: str) -> bool:
    return path_exists(spark, f"{root}/manifest")
