"""Hard negatives by threshold joins in the manner of L2AP.

A threshold join finds, for each anchor, all rows whose inner product with it reaches the anchor's threshold. A task
indexes its rows by dimension: dimensions have one order, and a row's leading ones, as many as the product of norms over
them stays below the least threshold, are left out of the index, since no pair can reach it by them alone. Scores are
accumulated over the lists from the last dimension to the first; a pair is pruned as soon as its partial score and the
norms of what remains can't reach the threshold. What was left out of the index is added for the few pairs that are left.

Positives are the best rows of the anchor's label. Each positive score opens a window of scores for rows of another
label. Thresholds begin high, near a window's upper end, and are lowered for the windows that have not filled, at last
to the lower end; a window that has filled above its threshold is final, because everything above it was found. Inside a
task a window that is full raises its threshold to its last score, so a task returns no more rows than a window needs.

Defined results: rows with a null label or a vector as ``vectors.whole`` leaves out take no part; of vectors of unequal
length the missing components count as 0; ties go to the smaller identifier, a null one is last; a row is no positive of
its own, rows that repeat are rows of their own; an anchor without another row of its label, and a positive with a score
below 0 or without a row in its window, has no result; an empty table gives an empty result; other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridplume.llm.va_file import ranked
from gridplume.llm.vectors import HITS, QUERIES, ROWS, Best, column, exact_type, matrix, portions, whole
from gridplume.session import as_written, work_path

#: Dimensions whose lists are accumulated before pairs are pruned.
DIMS = 16
#: Thresholds of the rounds: for positives shares of the anchor's inner product with itself, for negatives places between
#: the lower and the upper end of a window. The last round has no threshold, or the lower end.
POSITIVE_STEPS, NEGATIVE_STEPS = (0.5, 0.35, 0.2), (0.9, 0.6, 0.3)
#: A score that every row reaches.
NO_SCORE = -(2**62)
_WINDOW = ["key", "rid", "label", "same", "low", "high", "need", "threshold", "vec"]


def reaching(anchors: np.ndarray, thresholds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of all pairs whose inner product reaches the anchor's threshold.

    ``anchors`` and ``rows`` are whole numbers in a type in which their products are exact, dimensions in index order.
    """
    (n, width), m = anchors.shape, len(rows)
    # Norms of the first d dimensions, rounded up a little: bounds must not fall short.
    heads_a, heads_r = (_head_norms(v) for v in (anchors, rows))
    least = thresholds.min(initial=np.inf)
    left_out = ((heads_a.max(0, initial=0) * heads_r) < least).sum(1) - 1 if least > 0 else np.zeros(m, int)
    at_a, at_r = np.arange(n), np.nonzero(left_out < width)[0]
    left_out = np.maximum(left_out, 0)
    dims = np.arange(width)
    indexed = np.where(dims >= left_out[:, None], rows, 0)
    partial = np.zeros((n, len(at_r)), dtype=rows.dtype)
    high = width
    while True:
        # At the first turn nothing is known but the norms.
        rest = np.maximum(high, left_out[at_r])
        open_ = partial + heads_a[at_a][:, rest] * heads_r[at_r, rest] >= thresholds[at_a, None]
        keep_a, keep_r = open_.any(1), open_.any(0)
        at_a, at_r, partial, open_ = at_a[keep_a], at_r[keep_r], partial[keep_a][:, keep_r], open_[keep_a][:, keep_r]
        if high == 0 or not len(at_a) or not len(at_r):
            break
        low = max(0, high - DIMS)
        partial = partial + anchors[at_a, low:high] @ indexed[at_r, low:high].T
        high = low
    a, r = np.nonzero(open_)
    score, a, r = partial[a, r], at_a[a], at_r[r]
    for at in range(0, len(a), ROWS):
        part = slice(at, at + ROWS)
        head = np.where(dims < left_out[r[part], None], rows[r[part]], 0)
        score[part] += np.einsum("pd,pd->p", anchors[a[part]], head)
    good = score >= thresholds[a]
    return a[good], r[good], score[good].astype(np.float64)


def _head_norms(vectors: np.ndarray) -> np.ndarray:
    squares = np.cumsum(vectors.astype(np.float64) ** 2, axis=1)
    return np.sqrt(np.hstack([np.zeros((len(vectors), 1)), squares])) * (1 + 1e-9)


class Join:
    """The windows of a portion of the anchors against the rows of one task."""

    def __init__(self, windows: pa.Table):
        self.keys, rids, self.need = (column(windows, n) for n in ("key", "rid", "need"))
        self.high, self.threshold = (column(windows, n).astype(np.float64) for n in ("high", "threshold"))
        self.same, self.label = windows.column("same").to_numpy(), column(windows, "label")
        self.rids, first, self.anchor = np.unique(rids, return_index=True, return_inverse=True)
        width = int(np.diff(windows.column("vec").combine_chunks().offsets.to_numpy()).max(initial=0))
        anchors = matrix(windows.column("vec").combine_chunks().take(pa.array(first)), width)
        # Small dimensions first: they are the ones that the index may leave out.
        self.order = np.argsort((anchors**2).sum(0), kind="stable")
        self.anchors = anchors[:, self.order]
        # The windows of anchor a are slots[a], padded with -1.
        by_anchor = np.argsort(self.anchor, kind="stable")
        count = np.bincount(self.anchor, minlength=len(self.rids))
        place = np.arange(len(by_anchor)) - np.repeat(np.cumsum(count) - count, count)
        self.slots = np.full((len(self.rids), count.max(initial=0)), -1)
        self.slots[self.anchor[by_anchor], place] = by_anchor
        self.best = Best(len(self.keys), int(self.need.max(initial=1)))

    def batch(self, batch: pa.RecordBatch) -> None:
        rids, ids, labels = (column(batch, n) for n in ("rid", "id", "label"))
        rows = matrix(batch.column("vec"), self.anchors.shape[1])[:, self.order]
        kind = exact_type(self.anchors, np.abs(rows).max(initial=0))
        anchors, rows = self.anchors.astype(kind), rows.astype(kind)
        floor = self.floor()
        order = np.argsort(-floor, kind="stable")
        for at in range(0, len(order), QUERIES):
            own = order[at : at + QUERIES]
            a, row, score = reaching(anchors[own], floor[own], rows)
            a = own[a]
            for slot in range(self.slots.shape[1]):
                window = self.slots[a, slot]
                fits = (window >= 0) & (score <= self.high[window]) & (score >= self.threshold[window])
                fits &= (labels[row] == self.label[window]) == self.same[window]
                fits &= ~self.same[window] | (rids[row] != self.rids[a])
                self.best.add(window[fits], score[fits], ids[row[fits]])

    def floor(self) -> np.ndarray:
        """What a row must score to enter any window of an anchor."""
        full = np.take_along_axis(self.best.scores, self.need[:, None] - 1, 1)[:, 0] if len(self.need) else np.zeros(0)
        least = np.full(len(self.rids), np.inf)
        np.minimum.at(least, self.anchor, np.maximum(self.threshold, full))
        return least


def join(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """key, rank, id, score: of each window (see ``_WINDOW``) the best ``need`` rows that score from ``threshold`` to
    ``high``, of the same label (without the anchor itself) or of another."""
    spark = rows.sparkSession
    path = work_path(spark, "hits")
    spark.createDataFrame([], HITS).write.parquet(path)
    for portion in portions(windows.select(*_WINDOW)):
        shared = spark.sparkContext.broadcast(portion)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            task = None
            for batch in batches:
                task = task or Join(shared.value)
                for at in range(0, batch.num_rows, ROWS):
                    task.batch(batch.slice(at, ROWS))
            if task:
                yield task.best.rows(task.keys)

        rows.mapInArrow(scan, HITS).write.mode("append").parquet(path)
        shared.unpersist()
    found = ranked(spark.read.schema(HITS).parquet(path), F.lit(2**31 - 1))
    needs = windows.select("key", "need")
    return as_written(found.join(needs, "key").where("rank <= need").drop("need"), "found")


def fill(rows: DataFrame, windows: DataFrame, thresholds: Sequence) -> DataFrame:
    """As ``join``, down to each window's lower end: round by round with one threshold after the other (columns of
    ``windows``), and only for windows that have not filled."""
    done, open_ = None, windows
    for n, threshold in enumerate([*thresholds, F.col("low")]):
        found = join(rows, open_.withColumn("threshold", F.greatest(threshold.cast("long"), "low")))
        full = found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).join(open_.select("key", "need"), "key").where("n >= need").select("key")
        last = n == len(thresholds)
        final = found if last else found.join(full, "key", "left_semi")
        done = final if done is None else done.unionByName(final)
        if not last:
            open_ = as_written(open_.join(full, "key", "left_anti"), "open")
            if open_.isEmpty():
                break
    return done


def mine(
    rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low_percent: int = 30, high_percent: int = 90,
    id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose identifier is divisible by ``every``. For each of an anchor's first ``positives`` rows of
    its label: the first ``negatives`` rows of another label that score from ``low_percent`` to ``high_percent`` of the
    positive's score.
    """
    labelled = rows.where(rows[label_col].isNotNull())
    vectors = whole(labelled, id_col, vec_col, label=labelled[label_col].cast("long"))
    anchors = vectors.where(F.pmod("id", F.lit(every)) == 0)
    norm = F.aggregate("vec", F.lit(0).cast("long"), lambda s, x: s + x.cast("long") * x.cast("long"))
    wanted = anchors.select(
        F.col("rid").alias("key"), "rid", "label", F.lit(True).alias("same"), F.lit(NO_SCORE).alias("low"), F.lit(2**62).alias("high"),
        F.lit(positives).cast("long").alias("need"), norm.alias("norm"), "vec",
    )
    found = fill(vectors, as_written(wanted, "positives"), [F.col("norm") * step for step in POSITIVE_STEPS])
    found = as_written(found.select(F.col("key").alias("rid"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    low, high = F.expr(f"({low_percent} * positive_score + 99) div 100"), F.expr(f"{high_percent} * positive_score div 100")
    scores = found.where("positive_score >= 0").select("rid", "positive_score").distinct()
    windows = scores.join(anchors, "rid").select(
        F.monotonically_increasing_id().alias("key"), "rid", "positive_score", "label", F.lit(False).alias("same"), low.alias("low"), high.alias("high"),
        F.lit(negatives).cast("long").alias("need"), "vec",
    )
    windows = as_written(windows.where("low <= high"), "windows")
    hits = fill(vectors, windows, [F.col("low") + (F.col("high") - F.col("low")) * step for step in NEGATIVE_STEPS])
    return (
        hits.select("key", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(windows.select("key", "rid", "positive_score"), "key")
        .join(found, ["rid", "positive_score"])
        .join(anchors.select("rid", F.col("id").alias("anchor_id")), "rid")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
