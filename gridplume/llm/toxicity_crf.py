"""Toxicity by a linear-chain conditional random field over words.

Labels are per document, so words are labelled first: a word, or the beginning of a word, that occurs in so many
documents labelled toxic and in so few others that chance can't explain it marks its words as toxic, there and
nowhere else. A chain of two tags (other, toxic) is trained on windows of such labelled words. Over a whole text the
forward-backward pass gives each word's marginal probability; a small logistic model turns their sum, their largest and
their density into the document's score, and runs of words with a marginal of a half or more are the offending spans
(code points, end exclusive).

The model is fitted on the driver from a bounded sample of labelled rows (``Limits``); scoring is one pass over the
rows in Arrow batches, without a shuffle. Only the text is an input of a score.

Defined results: a null text counts as empty; a text without words has no spans and the score of "nothing found";
without a toxic label to learn from every score is the share of toxic labels (0 without labels); rows that repeat get
equal scores; other columns are not looked at.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from gridplume.llm.common import located, settings, without
from gridplume.session import as_written

_WORD = re.compile(r"\w+")
_BUCKETS = 1 << 18
_WORDS_KEPT = 200_000
#: Rows that go to a Python worker at once.
_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


@dataclass(frozen=True)
class Limits:
    """Bounds of the sample that the model is fitted on: so many labelled rows of so many characters in all, whose texts
    are read whole. The chain learns from all marked words of toxic documents with ``reach`` words on either side, and
    from all words of the others: each round of training takes a stretch of ``2 * reach + 1`` words in each ``spread``,
    the next round the next ones, until all had their turn."""

    rows: int = 6000
    chars: int = 64_000_000
    reach: int = 12
    spread: int = 500


@dataclass
class Model:
    """Weights of the chain: of hashed word features, of the four tag changes, of the document model."""

    base: float = 0.0
    weights: np.ndarray | None = None
    change: np.ndarray = field(default_factory=lambda: np.zeros(4))
    document: np.ndarray = field(default_factory=lambda: np.zeros(4))

    def scorer(self) -> Callable[[str], float]:
        """A function that sums up a word's weights."""
        weights, crc = self.weights.tolist(), zlib.crc32

        def emission(word: str) -> float:
            return sum([weights[crc(name.encode()) % _BUCKETS] for name in _names(word)])

        return emission


def in_training(doc_id: Column) -> Column:
    """Rows whose labels may be learnt from: crc32 of the identifier as text, mod 5, is not 0."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) != 0


def _marks(word: str) -> list[str]:
    """What a word can be known by: itself and its beginnings."""
    return [word + "$", *(word[:n] for n in (4, 5, 6) if len(word) > n)]


def _names(word: str) -> list[str]:
    return ["", *_marks(word), "3" + word[:3], "-" + word[-3:], f"#{min(len(word), 12)}"]


def _features(word: str) -> np.ndarray:
    return np.array([zlib.crc32(name.encode()) % _BUCKETS for name in _names(word)])


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def chain(emission: np.ndarray, starts: np.ndarray, lengths: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over many sequences that lie one after another in ``emission``.

    Two tags need only log-odds: returns the forward and backward log-odds of each word, whose sum is the log-odds of
    its marginal, and the order of the sequences. Sequences advance together, longest first, so that each step is over
    arrays.
    """
    oo, ot, to, tt = change
    order = np.argsort(-lengths, kind="stable")
    first, size = starts[order], lengths[order]
    forward, backward = np.zeros(len(emission)), np.zeros(len(emission))
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), side="left") if longest else []
    for t in range(longest):
        at = first[: active[t]] + t
        if t == 0:
            forward[at] = emission[at] + ot - oo
        else:
            before = forward[at - 1]
            forward[at] = emission[at] + np.logaddexp(ot, before + tt) - np.logaddexp(oo, before + to)
    for t in range(longest - 2, -1, -1):
        at = first[: active[t + 1]] + t
        after = emission[at + 1] + backward[at + 1]
        backward[at] = np.logaddexp(to, tt + after) - np.logaddexp(oo, ot + after)
    return forward, backward, order


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _by_chance(n: int, bad: int, rate: float) -> float:
    """The chance that ``bad`` or more of ``n`` documents are toxic, if each is with the chance ``rate``."""
    if rate >= 1:
        return 1.0
    head = math.lgamma(n + 1)
    logs = [head - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(rate) + (n - k) * math.log1p(-rate) for k in range(bad, n + 1)]
    return sum(map(math.exp, logs))


def label_words(texts: list[str], toxic: list[int]) -> set[str]:
    """The marks that stand for toxic words: so many of their documents are toxic (9 in 10 and two at least) that chance
    has less than 1 in 20 of making one such mark among all."""
    bad, all_ = Counter(), Counter()
    for text, label in zip(texts, toxic):
        marks = {m for w in set(_words(text)) for m in _marks(w)}
        all_.update(marks)
        if label:
            bad.update(marks)
    rate = sum(toxic) / max(len(toxic), 1)
    most = 0.05 / max(1, sum(1 for n in all_.values() if n > 1))
    chance: dict[tuple[int, int], float] = {}
    found = set()
    for m, n in bad.items():
        case = all_[m], n
        if n < max(2, 0.9 * all_[m]):
            continue
        if case not in chance:
            chance[case] = _by_chance(*case, rate)
        if chance[case] < most:
            found.add(m)
    return found


def _windows(texts: list[str], toxic: list[int], marks: set[str], limits: Limits = Limits(), most: int = 100) -> tuple[list[list[str]], list[list[int]]]:
    """Labelled words around all marked words of the toxic documents. A word is in one window; windows have ``most``
    words at most."""
    words, tags = [], []
    for own in (_words(text) for text, label in zip(texts, toxic) if label):
        hit = [int(any(m in marks for m in _marks(w))) for w in own]
        last = end = 0
        for n, i in enumerate(i for i, h in enumerate(hit) if h):
            start, end = max(end, i - limits.reach), min(len(own), i + limits.reach + 1)
            if n and start == last and len(words[-1]) + end - start <= most:
                words[-1] += own[start:end]
                tags[-1] += hit[start:end]
            elif start < end:
                words.append(own[start:end])
                tags.append(hit[start:end])
            last = end
    return words, tags


def stretches(lengths: np.ndarray, turn: int, limits: Limits = Limits()) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths, in texts of ``lengths`` words that lie one behind the other, of the stretches whose turn it is.
    Turns 0 to ``spread / (2 * reach + 1)``, rounded up, hold every word."""
    width = 2 * limits.reach + 1
    begin = np.cumsum(lengths) - lengths
    period = np.minimum(np.maximum(lengths, 1), limits.spread)
    slots = -(-period // width)
    # Texts start their turns at different places.
    first = (np.arange(len(lengths)) * 7919 + turn) % slots * width
    n = np.maximum(0, -(-(lengths - first) // limits.spread))
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = np.repeat(first, n) + nth * limits.spread
    # The last stretch of a period ends with it.
    size = np.minimum(np.minimum(width, limits.spread - np.repeat(first, n)), np.repeat(lengths, n) - start)
    return np.repeat(begin, n) + start, size


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def fit(texts: list[str], toxic: list[int], share: float, rounds: int = 80, decay: float = 1e-3, limits: Limits = Limits()) -> Model:
    """Trains the chain by gradient steps on the log-likelihood, then the document model."""
    model = Model(base=share)
    marks = label_words(texts, toxic)
    words, tags = _windows(texts, toxic, marks, limits)
    if not marks or not any(map(any, tags)):
        return model
    vocabulary: dict[str, int] = {}

    def numbers(lists: Iterable[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers, one list behind the other, and the lengths of the lists."""
        parts = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in own], dtype=np.int32) for own in lists]
        return np.concatenate([np.zeros(0, dtype=np.int32), *parts]), np.array([len(p) for p in parts], dtype=np.int64)

    near, near_lengths = numbers(words)
    other, other_lengths = numbers(_words(text) for text, label in zip(texts, toxic) if not label)
    near_truth = np.array([t for ts in tags for t in ts], dtype=float)
    rows = [_features(w) for w in vocabulary]
    flat, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    weights, change = np.zeros(_BUCKETS), np.zeros(4)
    weights_sq, change_sq = np.full(_BUCKETS, 1e-8), np.full(4, 1e-8)
    for turn in range(max(rounds, -(-limits.spread // (2 * limits.reach + 1)))):
        begins, sizes = stretches(other_lengths, turn, limits)
        at = np.concatenate([near, other[_ranges(begins, sizes)]])
        lengths = np.concatenate([near_lengths, sizes])
        starts = np.cumsum(lengths) - lengths
        truth = np.concatenate([near_truth, np.zeros(len(at) - len(near))])
        inner = np.ones(len(at), dtype=bool)
        inner[starts] = False
        later = np.flatnonzero(inner)
        before, after = truth[later - 1], truth[later]
        seen = np.array([((1 - before) * (1 - after)).sum(), ((1 - before) * after).sum(), (before * (1 - after)).sum(), (before * after).sum()])
        by_word = np.bincount(owner, weights[flat], minlength=len(rows))
        emission = by_word[at]
        forward, backward, _order = chain(emission, starts, lengths, change)
        wrong = truth - _sigmoid(forward + backward)
        gradient = np.bincount(flat, np.bincount(at, wrong, minlength=len(rows))[owner], minlength=_BUCKETS) - decay * len(at) * 0.01 * weights
        left, right = forward[later - 1], emission[later] + backward[later]
        four = np.stack([np.full(len(later), change[0]), change[1] + right, change[2] + left, change[3] + left + right])
        four = np.exp(four - four.max(axis=0))
        steps = seen - (four / four.sum(axis=0)).sum(axis=1)
        weights_sq += gradient**2
        change_sq += steps**2
        weights += 0.5 * gradient / np.sqrt(weights_sq)
        change += 0.5 * steps / np.sqrt(change_sq)
    model.weights, model.change = weights, change
    _fit_document(model, texts, toxic, share)
    return model


def _evidence(marginals: np.ndarray) -> np.ndarray:
    """Of a document: 1, how surely there is a toxic word, how many there are, how dense they are."""
    if not len(marginals):
        return np.array([1.0, 0.0, 0.0, 0.0])
    total = marginals.sum()
    return np.array([1.0, marginals.max(), math.log1p(total), math.sqrt(total / len(marginals))])


def _fit_document(model: Model, texts: list[str], toxic: list[int], share: float) -> None:
    """Logistic regression by Newton's steps; classes weigh as they do among all labels."""
    evidence = []
    sizes = np.cumsum([len(t) for t in texts]) // 3_000_000
    for _, portion in groupby(range(len(texts)), key=lambda k: sizes[k]):
        evidence += [_evidence(p) for p, _ in marginals_of(model, [texts[k] for k in portion])]
    x, y = np.array(evidence), np.array(toxic, dtype=float)
    own = min(max(y.mean(), 1e-6), 1 - 1e-6)
    weight = np.where(y == 1, share / own, (1 - share) / (1 - own))
    beta, ridge = np.zeros(x.shape[1]), np.diag([1e-3, 1e-1, 1e-1, 1e-1])
    for _ in range(25):
        p = _sigmoid(x @ beta)
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        beta += np.linalg.solve(hessian, x.T @ (weight * (y - p)) - ridge @ beta)
    # More evidence never lowers a score.
    beta[1:] = np.maximum(beta[1:], 0.0)
    model.document = beta


def marginals_of(model: Model, texts: list[str], known: dict[str, float] | None = None) -> Iterator[tuple[np.ndarray, str]]:
    """For each text the toxic marginals of its words, in the order of the texts."""
    known = {} if known is None else known
    emission = model.scorer()
    lengths, scores = [], []
    for text in texts:
        words = _words(text)
        lengths.append(len(words))
        try:
            scores.extend([known[w] for w in words])
        except KeyError:
            if len(known) > _WORDS_KEPT:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = emission(w)
            scores.extend([known[w] for w in words])
    lengths = np.array(lengths, dtype=np.int64)
    ends = np.cumsum(lengths)
    forward, backward, _ = chain(np.array(scores, dtype=float), ends - lengths, lengths, model.change)
    p = _sigmoid(forward + backward)
    for text, start, end in zip(texts, ends - lengths, ends):
        yield p[start:end], text


def _spans(text: str, marginals: np.ndarray) -> list[tuple[int, int, float]]:
    """Runs of words whose marginal is a half or more. Offsets are of the text as it is: lower-casing may change
    lengths."""
    if not len(marginals) or marginals.max() < 0.5:
        return []
    places = [m.span() for m in _WORD.finditer(text)]
    if len(places) != len(marginals):
        places = _places_lowered(text)
    found: list[tuple[int, int, float]] = []
    last = -2
    for i in np.flatnonzero(marginals >= 0.5):
        if i == last + 1:
            found[-1] = (found[-1][0], places[i][1], max(found[-1][2], float(marginals[i])))
        else:
            found.append((*places[i], float(marginals[i])))
        last = i
    return found


def _places_lowered(text: str) -> list[tuple[int, int]]:
    """Places in the text of the words of its lower-cased form, character by character."""
    origin = [i for i, c in enumerate(text) for _ in c.lower()]
    return [(origin[m.start()], origin[m.end() - 1] + 1) for m in _WORD.finditer(text.lower())]


SCORED = StructType([
    StructField("score", DoubleType()),
    StructField("predicted", IntegerType()),
    StructField("n_toxic", DoubleType()),
    StructField("spans", ArrayType(StructType([
        StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("p", DoubleType()),
    ]))),
])


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", limits: Limits = Limits()) -> Model:
    """Fits the model on the first labelled training rows in the order of a hash of their identifiers: ``limits.rows``,
    or as many before as have ``limits.chars`` characters in all, one at least."""
    marked = labels.where(labels[label_col].isNotNull() & labels[id_col].isNotNull() & in_training(labels[id_col]))
    rows = marked.select(labels[id_col].alias("id"), (labels[label_col] != 0).cast("int").alias("toxic")).groupBy("id").agg(F.max("toxic").alias("toxic"))
    share = rows.agg(F.avg("toxic")).first()[0]
    if not share:
        return Model(base=0.0)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(limits.rows)
    texts = docs.select(docs[id_col].alias("_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    # Of rows that share an identifier the least text is learnt from, so that reruns agree.
    joined = texts.join(sample, F.col("_id") == F.col("id")).groupBy("id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    # One narrow row for each row of the sample passes through one task.
    drawn = as_written(joined.withColumn("draw", F.xxhash64("id")), "drawn")
    sizes = drawn.select("id", "draw", F.length("text").cast("long").alias("size"))
    along = Window.orderBy("draw", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fitting = sizes.withColumns({"sum": F.sum("size").over(along), "nth": F.count(F.lit(1)).over(along)})
    fitting = fitting.where((F.col("sum") <= limits.chars) | (F.col("nth") == 1)).select("id")
    found = drawn.join(fitting, "id").select("id", "text", "toxic").orderBy("id").collect()
    return fit([r["text"] for r in found], [r["toxic"] for r in found], float(share), limits=limits)


def scorer(docs: DataFrame, model: Model):
    """A function of a text column that gives the struct ``SCORED``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(SCORED)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own, known = shared.value, {}
        for batch in batches:
            texts = batch.fillna("").tolist()
            yield pd.DataFrame(list(_scored(own, texts, known)), columns=SCORED.names)

    return score


def _scored(model: Model, texts: list[str], known: dict[str, float], most: int = 3_000_000) -> Iterator[tuple]:
    """Scores texts in portions of about ``most`` characters, so that long texts don't add up in memory."""
    portion, size = [], 0
    for k, text in enumerate(texts):
        portion.append(text)
        size += len(text)
        if size < most and k + 1 < len(texts):
            continue
        if model.weights is None:
            yield from ((model.base, int(model.base >= 0.5), 0.0, []) for _ in portion)
        else:
            for marginals, own in marginals_of(model, portion, known):
                value = float(_sigmoid(np.array(_evidence(marginals) @ model.document)))
                spans = [{"start": a, "end": b, "p": p} for a, b, p in _spans(own, marginals)]
                yield value, int(value >= 0.5), float(marginals.sum()), spans
        portion, size = [], 0


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, held_out, score, predicted, n_toxic (expected toxic words), spans."""
    model = learn(docs, labels, id_col, text_col)
    scored = docs.select(
        docs[id_col].alias("id"), (~in_training(docs[id_col])).alias("held_out"), scorer(docs, model)(docs[text_col]).alias("s")
    )
    return scored.select("id", "held_out", "s.score", "s.predicted", "s.n_toxic", "s.spans")


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those predicted toxic, with the columns as they are.

    Scoring reads the text alone and gives the places of the rejected rows; whole rows never pass through Python.
    """
    docs, place = located(docs)
    model = learn(docs, labels, id_col, text_col)
    scored = docs.select(place.alias("place"), scorer(docs, model)(docs[text_col])["predicted"].alias("predicted"))
    with settings(docs.sparkSession, _BATCH):
        rejected = as_written(scored.where("predicted = 1").select("place"), "rejected")
    return without(docs, place, rejected)
