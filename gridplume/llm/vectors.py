"""Vectors as whole numbers, queries in portions of bounded size, and the best scores of many queries at once.

A search sends a stated query set against all rows in blocks: a portion of the queries, bounded in bytes, goes to every
task by broadcast, and a task reads its rows batch by batch. A task returns the best k per query, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridplume.session import as_written

#: A component x is stored as floor(SCALE * x).
SCALE = 256
#: Components of this size or more can't be scaled and multiplied in a long: their rows take no part.
MOST = 2.0**18
#: What stands for a null identifier where identifiers are compared: it is the last of all.
LAST = np.iinfo(np.int64).max
#: Rows and queries that are multiplied at a time.
ROWS, QUERIES = 4096, 256
#: Whole numbers below this are exact as float64, sums and products too.
_EXACT = 2.0**53


def whole(rows: DataFrame, id_col: str, vec_col: str, **more: Column) -> DataFrame:
    """rid (one for each row), id, vec (array of whole numbers) and ``more``, as a written table.

    Rows with a null vector, or with a component that is null, not finite or beyond ``MOST``, take no part.
    """
    fits = F.forall(rows[vec_col], lambda x: F.coalesce(F.abs(x.cast("double")) < MOST, F.lit(False)))
    scaled = F.transform(rows[vec_col], lambda x: F.floor(x.cast("double") * SCALE).cast("int"))
    usable = rows.where(rows[vec_col].isNotNull() & fits)
    chosen = usable.select(rows[id_col].cast("long").alias("id"), F.when(fits, scaled).alias("vec"), *[c.alias(n) for n, c in more.items()])
    return as_written(chosen.select(F.monotonically_increasing_id().alias("rid"), "*"), "vectors")


def portions(queries: DataFrame, most_bytes: int = 16 << 20) -> Iterator[pa.Table]:
    """The rows of ``queries`` (rid, vec, ...) in portions of about ``most_bytes`` of vectors; rows of one rid stay
    together."""
    n, width = queries.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    parts = -(-n * 8 * max(width or 0, 8) // most_bytes)
    for part in range(parts):
        portion = queries.where(F.pmod(F.xxhash64("rid"), F.lit(parts)) == part).toArrow()
        if portion.num_rows:
            yield portion.combine_chunks()


def column(table: pa.Table | pa.RecordBatch, name: str) -> np.ndarray:
    """A column of whole numbers; a null is ``LAST``."""
    values = table.column(name)
    return values.fill_null(LAST).to_numpy() if isinstance(values, pa.ChunkedArray) else values.fill_null(LAST).to_numpy(zero_copy_only=False)


def matrix(vectors: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of ``width`` components: missing ones are 0, and those beyond have nothing to be multiplied
    with."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    starts = vectors.offsets.to_numpy()
    flat, lengths = vectors.values.to_numpy(zero_copy_only=False), np.diff(starts)
    if len(lengths) and (lengths == width).all():
        return flat[starts[0] : starts[-1]].reshape(-1, width).astype(np.float64)
    out = np.zeros((len(lengths), width))
    there = np.arange(width) < lengths[:, None]
    out[there] = flat[(starts[:-1, None] + np.arange(width))[there]]
    return out


def exact_type(queries: np.ndarray, most: float) -> type:
    """The number type in which inner products with components up to ``most`` are exact."""
    reach = np.abs(queries).max(initial=0) * most * max(queries.shape[1], 1)
    return np.float64 if reach < _EXACT else np.int64


class Best:
    """The best ``k`` (score, id) of each of ``n`` queries; higher scores come first, ties by smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores = np.full((n, k), -np.inf)
        self.ids = np.full((n, k), LAST)

    def last(self) -> np.ndarray:
        """The score of each query's kth; minus infinity while there are fewer."""
        return self.scores[:, -1]

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Takes in scored rows, any number per query."""
        if not len(query):
            return
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        owners, first, count = np.unique(query, return_index=True, return_counts=True)
        rank = np.arange(len(query)) - np.repeat(first, count)
        own = np.repeat(np.arange(len(owners)), count)
        few = rank < self.k
        new_scores, new_ids = np.full((len(owners), self.k), -np.inf), np.full((len(owners), self.k), LAST)
        new_scores[own[few], rank[few]], new_ids[own[few], rank[few]] = score[few], ids[few]
        scores, both = np.hstack([self.scores[owners], new_scores]), np.hstack([self.ids[owners], new_ids])
        order = np.lexsort((both, -scores), axis=-1)[:, : self.k]
        self.scores[owners] = np.take_along_axis(scores, order, 1)
        self.ids[owners] = np.take_along_axis(both, order, 1)

    def rows(self, names: np.ndarray) -> pa.RecordBatch:
        """(key, id, score) of all that is held; ``names`` has the queries' keys."""
        at, place = np.nonzero(self.scores > -np.inf)
        ids = self.ids[at, place]
        return pa.RecordBatch.from_arrays(
            [pa.array(names[at]), pa.array(ids, mask=ids == LAST), pa.array(self.scores[at, place].astype(np.int64))], ["key", "id", "score"]
        )


#: What tasks of a search return.
HITS = "key long, id long, score long"
