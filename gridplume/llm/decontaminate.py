"""Benchmark decontamination: training passages are queries to a BM25 index of the test items, by block-max WAND.

The index holds, for each word, the items it occurs in (postings, in item order) with the share that the word has in
the item's own BM25 score, so that an item's score is 1 for a passage with all its words. Postings lie in blocks of
items with their largest share. A passage is a window of a text; windows overlap by half. Items
of more than ``MOST_STRIDE`` words are dealt to classes of length, each with its own index and windows, so that an item
of any length lies whole in a window of its class. All items that score ``THRESHOLD`` or more are retrieved, none is left out for rank: first a
bound per passage and block of items (sum of the blocks' largest shares), then WAND with block maxima on the passages
that the bound lets through. A retrieved item is verified by word triples: enough of its question and of its answer
must stand in the passage. Changed words may leave a short part without a triple, so an item of ``2 * GRAM`` words or
more is verified too if it stands whole in the passage but for one word (changed, left out or put in), or if ``ALIGNED``
of its words, ``OVERLAP`` of its question's and ``ANSWERED`` of its answer's stand there in the same order and close
together (longest common subsequence). Characters of scripts that put no blanks between words are words of their own.

The index is small by construction: items are dealt to shards of at most ``SHARD_WORDS`` words, and the texts are
passed over once per shard. Word statistics are of all items, so that scores don't depend on shards. No text is moved.

Defined results: null and empty texts and items match nothing; a text is reported once per item, with its best passage;
rows that repeat are reported each; rows of one item_id are items of their own under one name, and those without an
item_id under a null one; other columns are not
looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain, groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridplume.session import as_written

K1, B = 1.2, 0.75
BLOCK = 2
THRESHOLD = 0.5
OVERLAP = 0.6
GRAM = 3
#: Shares of an item's and of its answer's words that must stand in order; words that may lie between them, as a share.
ALIGNED, ANSWERED, SLACK = 0.75, 0.5, 0.25
SHARD_WORDS = 2_000_000
#: A passage has twice the words of the longest item, within these bounds; for longer items it is doubled until they fit.
LEAST_STRIDE, MOST_STRIDE = 64, 1024
#: Thai, Lao, Burmese, Khmer; kana, Han: no blanks between words.
_UNSPACED = r"\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORD = re.compile(rf"[{_UNSPACED}]|[^\W{_UNSPACED}]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The answer of an item is its last sentence or line, or the last quarter of its words if it has but one."""
    parts = [w for w in (_words(p) for p in _SENTENCE.split(text.strip())) if w]
    if len(parts) > 1:
        return list(chain.from_iterable(parts[:-1])), parts[-1]
    words = parts[0] if parts else []
    cut = len(words) - max(1, len(words) // 4)
    return (words[:cut], words[cut:]) if cut > 0 else (words, words)


def grams(words: Sequence[str], n: int) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


class Passage:
    """The words of a passage; the runs of words in it are looked up once for all items."""

    def __init__(self, words: Sequence[str]):
        self.words = words
        self.grams: dict[int, set] = {}
        self.places: dict[str, list[int]] | None = None

    def overlap(self, part: Sequence[str]) -> float:
        """The share of the word triples of ``part`` (shorter parts: of itself as one) that stand in the passage."""
        n = min(GRAM, len(part))
        own = grams(part, n)
        if n not in self.grams:
            self.grams[n] = grams(self.words, n)
        return len(own & self.grams[n]) / len(own) if own else 0.0

    def holds_nearly(self, item: Sequence[str]) -> bool:
        """Whether all of ``item`` stands in the passage, but for one word at most; one of its halves does to the word."""
        half = len(item) // 2
        if half < GRAM:
            return False
        return _half_and_rest(item, half, self.words) or _half_and_rest(item[::-1], len(item) - half, self.words[::-1])


    def aligned(self, item: Sequence[str], question: int) -> tuple[int, int]:
        """How many words of ``item`` stand in the passage in order and close together, and how many of its first
        ``question`` words do there; (0, 0) if ``ALIGNED`` of them don't.

        A word of the item that stands in place is that far from its own place in the item, give or take the words put in
        or left out; so the passage is aligned only where enough equal words have nearly the same distance.
        """
        if self.places is None:
            self.places = defaultdict(list)
            for j, w in enumerate(self.words):
                self.places[w].append(j)
        n, band = len(item), max(2, int(SLACK * len(item)))
        least = math.ceil(ALIGNED * n)
        equal = Counter((j - i) // band for i, w in enumerate(item) for j in self.places.get(w, ()))
        best = (0, 0)
        for b in sorted({k for c in equal for k in (c - 1, c)}):
            if equal[b] + equal[b + 1] >= least:
                low = max(0, b * band)
                best = max(best, common(item, self.words[low : (b + 2) * band + n], question))
        return best if best[0] >= least else (0, 0)


def common(item: Sequence[str], words: Sequence[str], question: int) -> tuple[int, int]:
    """Lengths of the longest common subsequence of ``item`` and ``words``, and of its first ``question`` words.

    All places of the item are bits of one number: a bit is 0 where a common subsequence with the words so far gets
    longer.
    """
    at: dict[str, int] = defaultdict(int)
    for i, w in enumerate(item):
        at[w] |= 1 << i
    every = (1 << len(item)) - 1
    row = every
    for w in words:
        if w in at:
            same = row & at[w]
            row = ((row + same) | (row - same)) & every
    zeros = every & ~row
    return zeros.bit_count(), (zeros & ((1 << question) - 1)).bit_count()


def _half_and_rest(item: Sequence[str], half: int, words: Sequence[str]) -> bool:
    """Whether the first ``half`` words of ``item`` stand in ``words``, and behind them the others but for one."""
    head, rest = item[:half], item[half:]
    start = -1
    while True:
        try:
            start = words.index(head[0], start + 1)
        except ValueError:
            return False
        if words[start : start + half] == head:
            behind = words[start + half : start + len(item) + 1]
            same = next((k for k, (a, b) in enumerate(zip(rest, behind)) if a != b), min(len(rest), len(behind)))
            left, after = rest[same:], behind[same:]
            # Nothing differs, or a word is changed, left out or put in.
            if any(_begins(after[i:], left[j:]) for i, j in ((0, 0), (1, 1), (0, 1), (1, 0))):
                return True


def _begins(words: Sequence[str], part: Sequence[str]) -> bool:
    return words[: len(part)] == part


@dataclass
class Index:
    """Postings of the items' words. ``words`` gives a word's number; ``items``, ``shares`` and ``blocks`` are by that
    number. ``longer`` are the indexes of the items that don't fit into ``stride`` words."""

    names: list
    texts: list[str]
    words: dict[str, int]
    items: list[list[int]]
    shares: list[list[float]]
    blocks: list[dict[int, float]]
    most: np.ndarray
    stride: int
    longer: list[Index]

    @property
    def n_blocks(self) -> int:
        return (len(self.names) + BLOCK - 1) // BLOCK


def build(rows: list[tuple], df: dict[str, int], n_items: int, mean_length: float, longest: int) -> Index:
    """The index of ``rows`` (item_id, text), with the document frequencies of all items."""
    stride = min(max(longest, LEAST_STRIDE), MOST_STRIDE)
    classes: dict[int, list[tuple]] = defaultdict(list)
    for i, t in rows:
        n = len(_words(t)) if t else 0
        if n:
            classes[0 if n <= stride else (-(-n // stride) - 1).bit_length()].append((i, t))
    own, *longer = [_index(classes[k], df, n_items, mean_length, stride << k) for k in sorted({0, *classes})]
    own.longer = longer
    return own


def _index(rows: list[tuple], df: dict[str, int], n_items: int, mean_length: float, stride: int) -> Index:
    """The index of items that have a word and fit into ``stride`` words."""
    words: dict[str, int] = {}
    items: list[list[int]] = []
    shares: list[list[float]] = []
    for k, (_, text) in enumerate(rows):
        counts = Counter(_words(text))
        length = counts.total()
        weight = {
            w: math.log(1 + (n_items - df[w] + 0.5) / (df[w] + 0.5)) * n * (K1 + 1) / (n + K1 * (1 - B + B * length / mean_length))
            for w, n in counts.items()
        }
        total = sum(weight.values())
        for w, x in weight.items():
            at = words.setdefault(w, len(words))
            if at == len(items):
                items.append([])
                shares.append([])
            items[at].append(k)
            shares[at].append(x / total)
    blocks: list[dict[int, float]] = []
    for own, share in zip(items, shares):
        best: dict[int, float] = defaultdict(float)
        for k, s in zip(own, share):
            best[k // BLOCK] = max(best[k // BLOCK], s)
        blocks.append(dict(best))
    most = np.array([max(s) for s in shares]) if shares else np.zeros(0)
    return Index([i for i, _ in rows], [t for _, t in rows], words, items, shares, blocks, most, stride, [])


def wand(index: Index, terms: Sequence[int], threshold: float) -> list[tuple[int, float]]:
    """All items that score ``threshold`` or more for the words ``terms``.

    Cursors stand in the words' postings. The pivot is the first item that the words' largest shares let reach the
    threshold; if the block maxima there don't, all cursors before the end of the shortest block are moved past it.
    """
    cursors = [[index.items[t][0], 0, t] for t in terms]
    found = []
    eps = 1e-9
    while cursors:
        cursors.sort()
        bound, pivot = 0.0, -1
        for k, (_, _, t) in enumerate(cursors):
            bound += index.most[t]
            if bound >= threshold - eps:
                pivot = k
                break
        if pivot < 0:
            break
        item = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
            pivot += 1
        block = item // BLOCK
        if sum(index.blocks[t].get(block, 0.0) for _, _, t in cursors[: pivot + 1]) < threshold - eps:
            # No item of this block up to the next cursor can make it.
            goal = (block + 1) * BLOCK
            if pivot + 1 < len(cursors):
                goal = min(goal, cursors[pivot + 1][0])
        elif cursors[0][0] == item:
            score = sum(index.shares[t][at] for _, at, t in cursors[: pivot + 1])
            if score >= threshold - eps:
                found.append((item, score))
            goal = item + 1
        else:
            goal = item
        moved = []
        for own, at, t in cursors[: pivot + 1]:
            postings = index.items[t]
            while own < goal:
                at += 1
                if at == len(postings):
                    break
                own = postings[at]
            if own >= goal:
                moved.append([own, at, t])
        cursors = moved + cursors[pivot + 1 :]
    return found


class Searcher:
    """Finds items in texts; holds the arrays that the bounds of passages are computed from."""

    def __init__(self, index: Index, threshold: float = THRESHOLD, least: float = OVERLAP):
        self.index, self.threshold, self.least = index, threshold, least
        # The bounds of words of many blocks are rows of a matrix; rarer words have lists of blocks.
        spread = np.array([len(b) for b in index.blocks], dtype=np.int64)
        common = spread > max(2, index.n_blocks // 8)
        numbers = np.flatnonzero(common)
        self.matrix = np.zeros((len(numbers), index.n_blocks))
        for row, t in enumerate(numbers):
            for block, share in index.blocks[t].items():
                self.matrix[row, block] = share
        # By word, with a last entry for unknown words, numbered -1: the row in the matrix or -1, and whether it is
        # rare.
        self.row = np.append(np.where(common, np.cumsum(common) - 1, -1), -1)
        self.is_rare = np.append(~common, False)
        kept = [sorted(b.items()) if not c else [] for b, c in zip(index.blocks, common)]
        self.size = np.array([len(b) for b in kept], dtype=np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.block = np.array([x for b in kept for x, _ in b], dtype=np.int64)
        self.share = np.array([s for b in kept for _, s in b])
        self.parts = [question_and_answer(t) for t in index.texts]
        self.words = [_words(t) for t in index.texts]
        self.longer = [Searcher(i, threshold, least) for i in index.longer]

    def candidates(self, terms: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int]]:
        """(text, passage) where some block of items may reach the threshold. ``terms`` has -1 for unknown words."""
        stride = self.index.stride
        n_chunks = np.maximum(1, -(-lengths // stride))
        first_chunk = np.cumsum(n_chunks) - n_chunks
        at = np.arange(len(terms)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        chunk = np.repeat(first_chunk, lengths) + at // stride
        total, many = int(n_chunks.sum()), np.int64(len(self.size) + 1)
        owner = np.repeat(np.arange(len(lengths)), n_chunks)
        # Passage p of a text is its chunks p and p + 1.
        has_next = np.append(owner[1:] == owner[:-1], False)
        holds = np.zeros((total + 1, len(self.matrix)), dtype=bool)
        row = self.row[terms]
        holds[chunk[row >= 0], row[row >= 0]] = True
        holds[:-1] |= holds[1:] & has_next[:, None]
        bound = (holds[:-1].astype(np.float64) @ self.matrix).reshape(-1)
        rare = np.flatnonzero(self.is_rare[terms])
        chunk, term = chunk[rare], terms[rare]
        earlier = (chunk > 0) & has_next[np.maximum(chunk - 1, 0)]
        passage, term = np.divmod(np.unique(np.concatenate([chunk * many + term, (chunk[earlier] - 1) * many + term[earlier]])), many)
        n = self.size[term]
        post = np.repeat(self.first[term] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        np.add.at(bound, np.repeat(passage, n) * np.int64(self.index.n_blocks) + self.block[post], self.share[post])
        hot = np.flatnonzero((bound.reshape(total, -1) >= self.threshold - 1e-9).any(axis=1))
        return [(int(owner[p]), int(p - first_chunk[owner[p]])) for p in hot]

    def search(self, texts: Sequence[str]) -> Iterator[list[tuple]]:
        """For each text its verified items: (item_id, score, question, answer), each with its best passage."""
        words = [_words(t) for t in texts]
        found: dict[int, dict] = defaultdict(dict)
        for searcher in (self, *self.longer):
            for text, name, values in searcher.verified(words):
                found[text][name] = max(found[text].get(name, (0.0,)), values)
        for k in range(len(texts)):
            yield [(name, *found[k][name]) for name in sorted(found[k], key=lambda i: (i is None, i or 0))] if k in found else []

    def holds_edited(self, held: Passage, item: int) -> bool:
        """Whether enough of an item's words, of its question's and of its answer's, stand in order in the passage."""
        words, (question, answer) = self.words[item], self.parts[item]
        if len(words) < 2 * GRAM or len(question) + len(answer) != len(words):
            return False
        whole, first = held.aligned(words, len(question))
        return whole > 0 and first >= self.least * len(question) and whole - first >= ANSWERED * len(answer)

    def verified(self, words: Sequence[list[str]]) -> Iterator[tuple[int, int, tuple]]:
        """(text, item_id, (score, question, answer)) of this index's own items in the passages of texts."""
        get = self.index.words.get
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        terms = np.array([get(w, -1) for own in words for w in own], dtype=np.int64)
        if not len(self.index.names) or not len(terms):
            return
        starts = np.cumsum(lengths) - lengths
        for text, passage in self.candidates(terms, lengths):
            low = passage * self.index.stride
            high = low + 2 * self.index.stride
            own = terms[starts[text] + low : starts[text] + min(high, lengths[text])]
            held = Passage(words[text][low:high])
            for item, score in wand(self.index, np.unique(own[own >= 0]).tolist(), self.threshold):
                question, answer = map(held.overlap, self.parts[item])
                if min(question, answer) >= self.least or held.holds_nearly(self.words[item]) or self.holds_edited(held, item):
                    yield text, self.index.names[item], (score, question, answer)


def indexes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", shard_words: int = SHARD_WORDS) -> Iterator[Index]:
    """The index of each shard of the items."""

    @F.pandas_udf("array<string>")
    def words_udf(texts: pd.Series) -> pd.Series:
        return texts.fillna("").map(_words)

    items = as_written(
        benchmark.select(benchmark[id_col].cast("long").alias("item"), benchmark[text_col].alias("text"), words_udf(benchmark[text_col]).alias("words"))
        .where("size(words) > 0"),
        "items",
    )
    n_items, n_words, longest = items.agg(F.count(F.lit(1)), F.sum(F.size("words")), F.max(F.size("words"))).first()
    if not n_items:
        return
    shards = -(-n_words // shard_words)
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("item", "text"), F.lit(shards)))
    used = dealt.select("shard", "item", "text", F.explode(F.array_distinct("words")).alias("word"))
    df = used.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    for shard in range(shards):
        rows = dealt.where(F.col("shard") == shard).select("item", "text").orderBy("item", "text").collect()
        counts = used.where(F.col("shard") == shard).select("word").distinct().join(df, "word").collect()
        yield build([tuple(r) for r in rows], {r["word"]: r["df"] for r in counts}, n_items, n_words / n_items, longest)


HITS = "array<struct<item_id: long, score: double, question: double, answer: double>>"


def hits(text: Column, index: Index, threshold: float = THRESHOLD, most: int = 500_000) -> Column:
    """The verified items of a text, as a column. A task works on portions of about ``most`` characters."""

    @F.pandas_udf(HITS)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        searcher = Searcher(index, threshold)
        for batch in batches:
            texts = batch.fillna("").tolist()
            sizes = np.cumsum([len(t) for t in texts]) // most
            result: list = []
            for _, portion in groupby(range(len(texts)), key=lambda k: sizes[k]):
                own = [texts[k] for k in portion]
                result += [[{"item_id": i, "score": s, "question": q, "answer": a} for i, s, q, a in rows] for rows in searcher.search(own)]
            yield pd.Series(result)

    return search(text)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """A row (id, item_id, score, question, answer) for each row of ``docs`` and each item found in it."""
    found = docs.sparkSession.createDataFrame([], "id long, item_id long, score double, question double, answer double")
    for index in indexes(benchmark):
        rows = docs.select(docs[id_col].cast("long").alias("id"), F.explode(hits(docs[text_col], index, threshold)).alias("hit"))
        found = found.unionByName(rows.select("id", "hit.*"))
    return found


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a test item, with the columns as they are."""
    names = docs.columns
    for index in indexes(benchmark):
        column = "_hits"
        while column in names:
            column += "_"
        docs = docs.withColumn(column, hits(docs[text_col], index)).where(F.size(column) == 0).select(*names)
    return docs
