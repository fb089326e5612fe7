"""Exact top-k search by inner product with a vector-approximation file.

Every component of a vector is replaced by the number of its cell; the marks between cells are quantiles of a bounded
sample of rows, and the outermost cells reach to the least and the greatest value of all rows. A cell has a lower and an
upper end, so a row's cells bound its inner product with a query from above. A task scans the cells of its rows, and
of the rows whose bound reaches the query's kth best score so far it reads the exact vectors, best bound first, until
the next bound is below the kth best: then the result is certain. The scores in the sample are the first kth best, so
that few rows are read exactly.

The sample decides how tight cells are and where scores begin; whatever it holds, every row is indexed and searched and
the result is exact. Queries are compared in portions of bounded bytes, and a task returns k rows per query at most.

Defined results: vectors that are null or hold a null, a component that is not finite or one of 2^18 or more, take no
part; of vectors of unequal length the missing components count as 0; an empty vector scores 0; rows that repeat are
rows of their own, and a row is no candidate of its own; a null identifier is last in ties and asks no query; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridplume.llm.vectors import HITS, QUERIES, ROWS, Best, column, exact_type, matrix, portions, whole
from gridplume.session import as_written, work_path

#: Cells per dimension, and rows of the sample.
CELLS, SAMPLE = 64, 4096
#: Exact vectors read per query before bounds are looked at again.
STEP = 64


@dataclass(frozen=True)
class Index:
    """``rows``: rid, id, vec, cells (one byte per component). ``lows`` and ``highs``: the ends of each cell by
    dimension. ``sample``: rid, id, vec of the sampled rows."""

    rows: DataFrame
    lows: np.ndarray
    highs: np.ndarray
    sample: pa.Table


def build(rows: DataFrame, cells: int = CELLS, sample: int = SAMPLE) -> Index:
    """The file of all ``rows`` (rid, id, vec). Its marks are fitted on ``sample`` rows, taken by a hash."""
    few = rows.select("rid", "id", "vec").orderBy(F.xxhash64("rid"), "rid").limit(sample).toArrow().combine_chunks()
    ends = rows.mapInArrow(_ends, "dim int, low int, high int").groupBy("dim").agg(F.min("low"), F.max("high")).orderBy("dim").collect()
    # Vectors that are shorter than others count as 0 where they end.
    low, high = np.minimum([r[1] for r in ends], 0.0), np.maximum([r[2] for r in ends], 0.0)
    width = len(ends)
    cuts = np.ceil(np.quantile(matrix(few.column("vec"), width), np.arange(1, cells) / cells, axis=0)) if few.num_rows else np.zeros((cells - 1, width))
    # Cell c of a dimension holds the whole numbers from lows[c] to highs[c].
    lows, highs = np.vstack([np.full(width, -np.inf), cuts]), np.vstack([cuts - 1, np.full(width, np.inf)])
    lows, highs = np.clip(lows, low, high), np.clip(highs, low, high)
    marks = rows.sparkSession.sparkContext.broadcast(cuts)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = matrix(batch.column("vec"), width)
            codes = np.empty(values.shape, np.uint8)
            for d in range(width):
                codes[:, d] = np.searchsorted(marks.value[:, d], values[:, d], side="right")
            packed = pa.array([c.tobytes() for c in codes], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("rid", "id", "vec")), packed], ["rid", "id", "vec", "cells"])

    coded = rows.select("rid", "id", "vec").mapInArrow(encode, "rid long, id long, vec array<int>, cells binary")
    return Index(as_written(coded, "cells"), lows, highs, few)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least and the greatest component of each dimension in a task."""
    low = high = np.zeros(0)
    for batch in batches:
        lengths = np.diff(batch.column("vec").offsets.to_numpy())
        width = max(len(low), lengths.max(initial=0))
        values = matrix(batch.column("vec"), width)
        there = np.arange(width) < lengths[:, None]
        least, most = (np.full(width, end) for end in (np.inf, -np.inf))
        least[: len(low)], most[: len(high)] = low, high
        low = np.minimum(least, np.where(there, values, np.inf).min(0, initial=np.inf))
        high = np.maximum(most, np.where(there, values, -np.inf).max(0, initial=-np.inf))
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(low), dtype=np.int32)), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))], ["dim", "low", "high"])


class Scan:
    """A portion of the queries against the rows of one task."""

    def __init__(self, rids: np.ndarray, queries: np.ndarray, lows: np.ndarray, highs: np.ndarray, k: int):
        order = np.argsort(rids)
        self.rids, self.queries = rids[order], queries[order]
        most = max(np.abs(lows).max(initial=0), np.abs(highs).max(initial=0))
        self.kind = exact_type(queries, most)
        self.exact, self.sizes = self.queries.astype(self.kind), np.abs(self.queries)
        # A bound may lose this much to rounding, where scores are too large for exact floats.
        self.slack = self.sizes.sum(1) * most * 1e-12 if self.kind is np.int64 else np.zeros(len(rids))
        self.middles, self.halves = (lows + highs) / 2, (highs - lows) / 2
        self.best = Best(len(rids), k)
        self.floor = np.full(len(rids), -np.inf)

    def start(self, sample: pa.Table) -> None:
        """Scores of sampled rows are first kth best scores; the rows themselves come later."""
        for at in range(0, sample.num_rows, ROWS):
            part = sample.slice(at, ROWS)
            rids, ids, vectors = column(part, "rid"), column(part, "id"), matrix(part.column("vec"), self.queries.shape[1]).astype(self.kind)
            for low in range(0, len(self.rids), QUERIES):
                own = slice(low, low + QUERIES)
                scores = (self.exact[own] @ vectors.T).astype(np.float64)
                scores[self.own_pairs(own, rids)] = -np.inf
                query, row = np.nonzero((scores >= self.best.last()[own, None]) & (scores > -np.inf))
                self.best.add(query + low, scores[query, row], ids[row])
        self.floor, self.best = self.best.last().copy(), Best(len(self.rids), self.best.k)

    def own_pairs(self, queries: slice, rids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) of the queries that are rows of the batch themselves."""
        _, query, row = np.intersect1d(self.rids[queries], rids, assume_unique=True, return_indices=True)
        return query, row

    def least(self, query: np.ndarray | slice) -> np.ndarray:
        """The score that a row needs to be among a query's best k."""
        return np.maximum(self.best.last()[query], self.floor[query])

    def batch(self, batch: pa.RecordBatch) -> None:
        width = self.queries.shape[1]
        rids, ids, vectors = column(batch, "rid"), column(batch, "id"), matrix(batch.column("vec"), width).astype(self.kind)
        codes = np.frombuffer(b"".join(batch.column("cells").to_pylist()), np.uint8).reshape(len(rids), width)
        dims = np.arange(width)
        middles, halves = self.middles[codes, dims], self.halves[codes, dims]
        for low in range(0, len(self.rids), QUERIES):
            own = slice(low, low + QUERIES)
            bounds = self.queries[own] @ middles.T + self.sizes[own] @ halves.T + self.slack[own, None]
            bounds[self.own_pairs(own, rids)] = -np.inf
            query, row = np.nonzero((bounds >= self.least(own)[:, None]) & (bounds > -np.inf))
            self.read(query + low, row, bounds[query, row], vectors, ids)

    def read(self, query: np.ndarray, row: np.ndarray, bound: np.ndarray, vectors: np.ndarray, ids: np.ndarray) -> None:
        """Exact scores in the order of bounds, some per query at a time, until no bound reaches the kth best."""
        order = np.lexsort((-bound, query))
        query, row, bound = query[order], row[order], bound[order]
        while len(query):
            owners, first, count = np.unique(query, return_index=True, return_counts=True)
            now = np.arange(len(query)) - np.repeat(first, count) < STEP
            scores = np.einsum("pd,pd->p", self.exact[query[now]], vectors[row[now]]).astype(np.float64)
            good = scores >= self.least(query[now])
            self.best.add(query[now][good], scores[good], ids[row[now]][good])
            left = ~now & (bound >= self.least(query))
            query, row, bound = query[left], row[left], bound[left]


def search(index: Index, queries: DataFrame, k: int) -> DataFrame:
    """key (a query's rid), rank, id, score: the best ``k`` rows of the index for each of ``queries`` (rid, vec)."""
    spark = queries.sparkSession
    width = index.lows.shape[1]
    path = work_path(spark, "hits")
    spark.createDataFrame([], HITS).write.parquet(path)
    for portion in portions(queries.select("rid", "vec")):
        told = (column(portion, "rid"), matrix(portion.column("vec"), width), index.lows, index.highs, k)
        shared = spark.sparkContext.broadcast((told, index.sample))

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            told, sample = shared.value
            task = None
            for batch in batches:
                if task is None:
                    task = Scan(*told)
                    task.start(sample)
                for at in range(0, batch.num_rows, ROWS):
                    task.batch(batch.slice(at, ROWS))
            if task:
                yield task.best.rows(task.rids)

        index.rows.mapInArrow(scan, HITS).write.mode("append").parquet(path)
        shared.unpersist()
    return ranked(spark.read.schema(HITS).parquet(path), F.lit(k))


def ranked(hits: DataFrame, k: Column) -> DataFrame:
    """The best ``k`` hits of each key, with their rank."""
    order = Window.partitionBy("key").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(rows: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose identifier is divisible by ``every``, the ``k`` other rows with
    the greatest inner products of vectors scaled to whole numbers."""
    vectors = whole(rows, id_col, vec_col)
    queries = vectors.where(F.pmod("id", F.lit(every)) == 0)
    found = search(build(vectors), queries, k)
    named = found.join(queries.select(F.col("rid").alias("key"), F.col("id").alias("query_id")), "key")
    return named.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
