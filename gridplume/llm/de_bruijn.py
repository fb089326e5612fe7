"""Collocations from a weighted de Bruijn graph of words.

Texts are cut into pieces and pieces into words. Only the longest phrases, of five words, are counted where they stand:
they are the edges of the graph, each from the node of its first four words to the node of its last four. A node's count
is the flow out of it, the sum of its edges, and one more for each piece that ends there, since no edge leaves from
there. In the same way every shorter phrase gets its count from the phrases one word longer that begin with it and the
pieces that end with it, down to pairs. An edge whose whole flow goes on to one edge, which has no other, is compacted
with it to a path; phrases of a path share one count.

A phrase with a rare word or a rare pair of words can't be frequent. Words are counted first, then pairs of the words
that are left, these by hash; bitmaps of fixed size tell tasks what is rare, and there a text is cut, as if a piece
ended. Rare words and pairs that share a bucket with frequent ones only cost time, so counts are exact however many
there are.

Tasks combine phrases before they are shuffled, and counts are keyed by whole phrases, so a language or a word with a
third of all rows is many keys.

Defined results: a null text is empty; a null language is ``und``, together with rows that say so; an empty text has no
words, an empty table no phrases; rows that repeat count each; very long texts are read whole; ties go to the higher
count, then to the phrase that is first in byte order; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridplume.llm.common import settings
from gridplume.session import as_written

#: Words of the longest phrases.
LONGEST = 5
#: Hash buckets by which rare words and rare pairs are known: bitmaps of 2 and 16 MB at any size of the input.
WORD_BUCKETS, PAIR_BUCKETS, GROUP = 2**24, 2**27, 2**15
#: Words that are looked at together in a task, and phrases that it combines before they are sent.
PORTION, COMBINED = 2**20, 2**20
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A piece's end among words; no byte of a text.
_END = b"\xff"
_BYTES = bytes.maketrans(_UPPER.encode() + b"\t.,;:!?\x0a\x0b\x0c\x0d", _UPPER.lower().encode() + b" " + b"\n" * 10)


@dataclass(frozen=True)
class Graph:
    """``phrases``: lang, words, phrase, count, of all phrases of 1 to ``LONGEST`` words with the least count or more.
    ``totals``: lang, n (all words)."""

    phrases: DataFrame
    totals: DataFrame


def _bitmap(counts: DataFrame, least: int, buckets: int) -> np.ndarray:
    """A bit for each bucket of ``counts`` (bucket, n): whether its ``n`` sum up to ``least``."""
    usual = counts.groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    bits = usual.groupBy(F.floor(F.col("bucket") / GROUP).alias("group")).agg(
        F.bitmap_construct_agg(F.pmod("bucket", F.lit(GROUP))).alias("bits")
    )
    found = np.zeros(buckets // 8, np.uint8)
    # At most buckets / GROUP rows of 4 KB.
    for row in bits.collect():
        found[row["group"] * (GROUP // 8) : (row["group"] + 1) * (GROUP // 8)] = np.frombuffer(row["bits"], np.uint8)
    return found


def _is_set(bitmap: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    return (bitmap[buckets >> 3] >> (buckets & 7)) & 1 == 1


def _word_counts(texts: DataFrame) -> DataFrame:
    """lang, word, n."""
    lowered = F.translate("text", _UPPER, _UPPER.lower())
    word = F.explode(F.split(lowered, r"[\x20\x09.,;:!?\x0A-\x0D]+")).alias("word")
    return texts.select("lang", word).where("word <> ''").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))


class Words:
    """The words of a portion of texts as numbers; a piece's end and rare words are -1."""

    def __init__(self, words: list[bytes], usual_words: np.ndarray):
        coded = pa.array(words, pa.binary()).dictionary_encode()
        self.names, numbers = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        listed = self.names.to_pylist()
        end = listed.index(_END)
        self.hashes = np.fromiter((zlib.crc32(w) for w in listed), np.uint64, len(listed))
        usual = _is_set(usual_words, (self.hashes % np.uint64(8 * len(usual_words))).astype(np.int64))
        usual[end] = False
        self.numbers = np.where(usual[numbers], numbers, -1)
        self.stands = self.numbers >= 0

    def pairs(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Where a word follows a word, and the bucket of the two."""
        second = np.nonzero(self.stands[1:] & self.stands[:-1])[0] + 1
        first, last = self.hashes[self.numbers[second - 1]], self.hashes[self.numbers[second]]
        mixed = (first * np.uint64(2654435761) + last) * np.uint64(0x9E3779B97F4A7C15)
        return second, ((mixed >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)

    def runs(self, usual_pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each word how many stand before it in one run of usual pairs, with itself, and whether it ends the run."""
        second, buckets = self.pairs(8 * len(usual_pairs))
        follows = np.zeros(len(self.numbers) + 1, bool)
        follows[second] = _is_set(usual_pairs, buckets)
        place = np.arange(len(self.numbers))
        start = np.maximum.accumulate(np.where(follows[:-1], 0, place))
        return np.where(self.stands, place - start + 1, 0), self.stands & ~follows[1:]

    def counted(self, last: np.ndarray, k: int) -> tuple[pa.Array, np.ndarray]:
        """The phrases of ``k`` words that end at ``last``, each once, and their counts."""
        key = np.zeros(len(last), np.int64)
        for back in range(k - 1, -1, -1):
            key = np.unique(key * len(self.names) + self.numbers[last - back], return_inverse=True)[1]
        _, first, count = np.unique(key, return_index=True, return_counts=True)
        parts = [self.names.take(pa.array(self.numbers[last[first] - back])) for back in range(k - 1, -1, -1)]
        return pc.binary_join_element_wise(*parts, b" ").cast(pa.string()), count


def _portions(batches: Iterator[pa.RecordBatch], size: int, by_lang: bool) -> Iterator[tuple[str, list[bytes]]]:
    """(language, words) of about ``size`` words at a time. Pieces and texts end with ``_END``."""
    open_: dict[str, list[bytes]] = {}
    held = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            words = text.encode().translate(_BYTES).replace(b"\n", b" " + _END + b" ").split()
            own = open_.setdefault(lang if by_lang else "", [])
            own += words
            own.append(_END)
            held += len(words) + 1
            if held >= size:
                yield from open_.items()
                open_, held = {}, 0
    yield from open_.items()


def _pair_counts(texts: DataFrame, usual_words: np.ndarray, buckets: int, portion: int) -> DataFrame:
    """bucket, n: how many pairs of usual words of a bucket there are, combined in tasks."""
    shared = texts.sparkSession.sparkContext.broadcast(usual_words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words in _portions(batches, portion, by_lang=False):
            found, counts = np.unique(Words(words, shared.value).pairs(buckets)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(counts.astype(np.int32))], ["bucket", "n"])

    return texts.select("lang", "text").mapInArrow(count, "bucket int, n int")


class Combiner:
    """Sums up counted phrases in a task until there are too many to hold."""

    _KEYS = ["lang", "words", "phrase"]

    def __init__(self, most: int):
        self.most, self.held = most, []

    def add(self, lang: str, k: int, phrases: pa.Array, counts: np.ndarray) -> None:
        size = len(phrases)
        langs = pa.array([lang], pa.string()).take(pa.array(np.zeros(size, np.int64)))
        columns = [langs, pa.array(np.full(size, k, np.int32)), phrases, pa.array(counts.astype(np.int64))]
        self.held.append(pa.table(columns, [*self._KEYS, "count"]))

    def full(self) -> Iterator[pa.RecordBatch]:
        """What must be sent now: everything, if even summed up it is half of the most."""
        if sum(t.num_rows for t in self.held) >= self.most:
            self.held = [self._summed()]
            if self.held[0].num_rows >= self.most // 2:
                yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield from self._summed().to_batches(max_chunksize=100_000)
        self.held = []

    def _summed(self) -> pa.Table:
        table = pa.concat_tables(self.held).group_by(self._KEYS).aggregate([("count", "sum")])
        return table.rename_columns([*self._KEYS, "count"])


def _combined(texts: DataFrame, usual_words: np.ndarray, usual_pairs: np.ndarray, portion: int, combined: int) -> DataFrame:
    """lang, words, phrase, count: phrases of ``LONGEST`` words, and the last words of pieces; combined in tasks.

    Of a piece's end only the last four words are sent, or the whole piece: shorter ends are their ends. A word alone
    has been counted.
    """
    shared = texts.sparkSession.sparkContext.broadcast((usual_words, usual_pairs))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        combiner = Combiner(combined)
        for lang, listed in _portions(batches, portion, by_lang=True):
            words = Words(listed, shared.value[0])
            run, ends = words.runs(shared.value[1])
            combiner.add(lang, LONGEST, *words.counted(np.nonzero(run >= LONGEST)[0], LONGEST))
            for k in range(2, LONGEST):
                combiner.add(lang, k, *words.counted(np.nonzero(ends & (np.minimum(run, LONGEST - 1) == k))[0], k))
            yield from combiner.full()
        yield from combiner.rest()

    return texts.select("lang", "text").mapInArrow(count, "lang string, words int, phrase string, count long")


def build(
    docs: DataFrame, least: int = 50, text_col: str = "text", lang_col: str = "lang",
    word_buckets: int = WORD_BUCKETS, pair_buckets: int = PAIR_BUCKETS, portion: int = PORTION, combined: int = COMBINED,
) -> Graph:
    """The graph of all of ``docs``, with exact counts of all phrases that occur ``least`` times or more: it answers for
    any least count from that on, without another look at the texts.

    Buckets (multiples of ``GROUP``), ``portion`` (words) and ``combined`` (phrases) change what it costs, not what it
    finds.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(docs[lang_col], F.lit("und")).alias("lang"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    words = as_written(_word_counts(texts), "words")
    bucket = F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(word_buckets)).alias("bucket")
    usual_words = _bitmap(words.select(bucket, "n"), least, word_buckets)
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "500"}):
        usual_pairs = _bitmap(_pair_counts(texts, usual_words, pair_buckets, portion), least, pair_buckets)
        # Tasks have combined what they send; to combine it once more before the shuffle would find little.
        sent = _combined(texts, usual_words, usual_pairs, portion, combined).repartition("lang", "words", "phrase")
        edges = as_written(_summed(sent), "edges")
    flow, found = edges.where(F.col("words") == LONGEST), []
    found.append(flow.where(F.col("count") >= least))
    for k in range(LONGEST - 1, 1, -1):
        out = flow.select("lang", F.lit(k).alias("words"), F.substring_index("phrase", " ", k).alias("phrase"), "count")
        ends = edges.where(f"words between {k} and {LONGEST - 1}")
        ends = ends.select("lang", F.lit(k).alias("words"), F.substring_index("phrase", " ", -k).alias("phrase"), "count")
        flow = as_written(_summed(out.unionByName(ends)), "nodes")
        found.append(flow.where(F.col("count") >= least))
    found.append(words.where(F.col("n") >= least).select("lang", F.lit(1).alias("words"), F.col("word").alias("phrase"), F.col("n").alias("count")))
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return Graph(as_written(reduce(DataFrame.unionByName, found), "phrases"), as_written(totals, "totals"))


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("lang", "words", "phrase").agg(F.sum("count").alias("count"))


def _head(phrase: str, words: str) -> Column:
    return F.expr(f"substring_index({phrase}, ' ', {words})")


def _tail(phrase: str, words: str) -> Column:
    return F.expr(f"substring_index({phrase}, ' ', -({words}))")


def paths(graph: Graph) -> DataFrame:
    """lang, phrase, path, place, path_words: for each edge the path that it was compacted to, named by its first edge,
    and how far behind it the edge is.

    An edge's predecessor is the one whose node passes its whole flow on to it. Each round doubles the reach of the
    pointers, so rounds grow as the logarithm of the longest path. A path ends: no piece is endless.
    """
    k = LONGEST - 1
    edges = graph.phrases.where(F.col("words") == LONGEST).select("lang", "phrase", "count")
    nodes = graph.phrases.where(F.col("words") == k).select("lang", F.col("phrase").alias("node"), "count")
    unary = [F.col(c) for c in ("lang", "node", "count")]
    into = edges.withColumn("node", _tail("phrase", str(k))).select(*unary, F.col("phrase").alias("before"))
    out = edges.withColumn("node", _head("phrase", str(k))).select(*unary, "phrase")
    links = out.join(nodes, ["lang", "node", "count"]).join(into, ["lang", "node", "count"]).select("lang", "phrase", "before")
    state = edges.join(links, ["lang", "phrase"], "left").select(
        "lang", "phrase", F.coalesce("before", "phrase").alias("path"), F.col("before").isNotNull().cast("long").alias("place")
    )
    state, reach = as_written(state, "paths"), -1
    while True:
        moved = state.agg(F.sum("place")).first()[0]
        if not moved or moved == reach:
            break
        reach = moved
        step = state.select("lang", F.col("phrase").alias("path"), F.col("path").alias("further"), F.col("place").alias("more"))
        state = as_written(
            state.join(step, ["lang", "path"]).select("lang", "phrase", F.col("further").alias("path"), (F.col("place") + F.col("more")).alias("place")), "paths"
        )
    sizes = state.groupBy("lang", "path").agg((F.max("place") + LONGEST).alias("path_words"))
    return state.join(sizes, ["lang", "path"]).select("lang", "phrase", "path", "place", "path_words")


def collocations(graph: Graph, least: int = 100, most: int = 2000, cover_percent: int = 100) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, path_words: of the phrases that occur ``least`` times or more the ``most``
    best of each language.

    A phrase scores floor(1000 a n / (l r)) at its worst cut. One that a longer phrase holds ``cover_percent`` of the
    time or more is left out: it suffices to look at phrases one word longer, which are no rarer than those that hold
    them. ``path_words`` is the length of the path through a phrase of the longest kind, else the phrase's own.
    """
    graph = Graph(graph.phrases.where(F.col("count") >= least), graph.totals)
    phrases = graph.phrases
    parts = F.explode(F.array(_head("phrase", "words - 1"), _tail("phrase", "words - 1")))
    longer = phrases.where("words > 2").select("lang", parts.alias("phrase"), "count").groupBy("lang", "phrase").agg(F.max("count").alias("held"))
    candidates = phrases.where("words > 1").join(longer, ["lang", "phrase"], "left")
    candidates = candidates.where(f"held is null or 100 * held < {cover_percent} * count").drop("held")
    cuts = candidates.select("lang", "phrase", "words", F.col("count").alias("a"), F.explode(F.expr("sequence(1, words - 1)")).alias("cut"))
    known = phrases.select("lang", "phrase", "count")
    first = known.select(F.col("lang"), F.col("phrase").alias("first"), F.col("count").alias("l"))
    rest = known.select(F.col("lang"), F.col("phrase").alias("rest"), F.col("count").alias("r"))
    whole = (
        cuts.withColumns({"first": _head("phrase", "cut"), "rest": _tail("phrase", "words - cut")})
        .join(first, ["lang", "first"]).join(rest, ["lang", "rest"]).join(graph.totals, "lang")
    )
    # Whole decimals of 38 digits: counts have up to 18.
    score = F.expr("(cast(1000 as decimal(4, 0)) * cast(a as decimal(16, 0)) * cast(n as decimal(18, 0))) div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))")
    worst = whole.groupBy("lang", "phrase", "words", "a", "n").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("worst"))
    order = Window.partitionBy("lang").orderBy(F.col("worst.score").desc(), F.col("a").desc(), "phrase")
    best = worst.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= most)
    long_paths = paths(graph).select("lang", "phrase", "path_words")
    return best.join(long_paths, ["lang", "phrase"], "left").select(
        "lang", "rank", "phrase", "a", "worst.l", "worst.r", "n", "worst.score", F.coalesce("path_words", F.col("words").cast("long")).alias("path_words")
    )
