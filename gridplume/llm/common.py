"""What the operators of this subpackage share: tables, row locators, words, running totals, connected components."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridplume.session import as_written

#: A word is a maximal run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def located(docs: DataFrame) -> tuple[DataFrame, Column]:
    """``docs`` and a column that tells its physical rows apart, rows that are equal in all columns too.

    Rows of a file have a place (file, row); a frame that isn't read from files is written first.
    """
    try:
        place = docs.metadataColumn("_metadata")
        docs.select(place["row_index"])
    except AnalysisException:
        docs = as_written(docs, "rows")
        place = docs.metadataColumn("_metadata")
    return docs, F.struct(place["file_path"].alias("file"), place["row_index"].alias("row"))


def without(docs: DataFrame, place: Column, dropped: DataFrame) -> DataFrame:
    """``docs`` (from ``located``) without the rows whose place is in ``dropped.place``; all columns stay as they
    are."""
    names = docs.columns
    marked = docs.select(*[docs[c] for c in names], place.alias("_own_place"))
    gone = dropped.select(F.col("place").alias("_gone_place"))
    kept = marked.join(
        gone,
        (F.col("_own_place.file") == F.col("_gone_place.file")) & (F.col("_own_place.row") == F.col("_gone_place.row")),
        "left_anti",
    )
    return kept.select(*names)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs that run inside."""
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def words_of(text: Column) -> Column:
    """The lower-cased words of a text as an array; null and empty texts have none."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), GAP)
    return F.filter(parts, lambda w: w != "")


def running_total(
    rows: DataFrame, group: Sequence[str], lane: str, order: Sequence[str | Column], value: str, out: str
) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the same group that come before, by lane and then by order.

    No task sees a whole group: totals of the lanes are summed up first (one row each, combined before the shuffle),
    and a window runs inside one lane only. ``lane`` must not be null and grows with ``order``.
    """
    keys = [*group, lane]
    sums = rows.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    along = Window.partitionBy(*group).orderBy(lane).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = sums.select(*[F.col(k).alias(f"_b_{k}") for k in keys], (F.sum("_sum").over(along) - F.col("_sum")).alias("_before"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn("_local", F.sum(value).over(inside) - F.col(value))
    same = [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys]
    joined = local.join(before, same, "inner")
    return joined.withColumn(out, F.col("_local") + F.col("_before")).drop("_local", "_before", *[f"_b_{k}" for k in keys])


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b: long): one row (node, root) for each node of an edge, root the least
    node.

    Alternates large-star and small-star steps. Each is a minimum per node, combined before the shuffle, and a join that
    adaptive execution splits for hot nodes; each round is a written table. Rounds grow as the logarithm of the
    longest chain. It ends when a round changes nothing, and raises rather than return a part.
    """
    current = as_written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _print(current)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        both = current.select("a", "b").unionAll(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.join(least, F.col("a") == F.col("u")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lows = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        small = large.join(lows, F.col("a") == F.col("u")).select(
            F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        )
        following = as_written(small.select("e.a", "e.b").where("a <> b").distinct(), "edges")
        before, state, current = state, _print(following), following
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)


def _print(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"] or 0
