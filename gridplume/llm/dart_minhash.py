"""Near-duplicate classes by DartMinHash signatures and banded joining.

A document is the multiset of its five-word shingles; the similarity of two is the weighted Jaccard similarity, sum of
least counts over sum of largest. Each unit of weight of a shingle is a region that hashed darts hit: their ranks are a
Poisson process, and each has a coordinate. Per coordinate the earliest dart of a document is its sample, and two
documents share a sample with a chance equal to their similarity. Darts are thrown up to the rank where about ``size
(ln size + 3)`` of them fall on the document, however heavy it is; where a coordinate stays empty the rank is doubled.

Documents with the same words are one node. Nodes meet in buckets, one per band of the signature, and every
candidate pair is verified on its shingles:

1. each member of a bucket against the bucket's hub, the member that meets most others; verified links give classes;
2. where a bucket still holds several classes, pairs of different classes that deviate from the hub alike.

What two members deviate in from each other is the symmetric difference of their deviations from the hub. So two that are
similar, though not both to the hub, share so many deviations that they share one among their rarest (``prefixes``). A
bucket with a large group of near copies costs a pair per member and, for those that resemble none of the others, their
own deviations: no pair of different classes that meets in a bucket is passed over, and nothing is capped. Links between
classes then join them. Before texts are fetched for the first step, a pair's similarity is estimated from the whole
signatures, four bits a sample; it is given up where more of them differ than a pair at the threshold has a chance of
``GIVEN_UP`` of, by the binomial tail (``far``). The second step finds such a pair again where its bucket is not settled.

Defined results: words are lower-cased and split at ASCII white space; fewer than five words are one shingle; texts
without words (null, empty) are equal to each other; in a class the row with the least identifier stays (null last; of
equal ones the first row); an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from gridplume.llm.common import components, located, settings, words_of
from gridplume.session import as_written

SHINGLE = 5
#: 40 bands of 7: a pair of similarity 0.8 is missed with a chance of 8 in 100,000.
BANDS, BAND_ROWS = 40, 7
#: The chance of a pair at the threshold to be given up by its signatures, at most.
GIVEN_UP = 1e-6
#: Samples in a long, of four bits each.
PACKED = 16
#: Words that are worked on at once in a task, about. Documents of few words take many throws and are worked on
#: together.
PORTION, FEW = 50_000, 40
#: Rows that go to a Python worker at once.
_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}
#: A hub with more pairs than this is copied, so that each copy meets about so many.
PAIRS_PER_COPY = 1000

_U = np.uint64
_GOLDEN, _MIX1, _MIX2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: 64 well-mixed bits from 64 bits."""
    x = (x ^ (x >> _U(30))) * _MIX1
    x = (x ^ (x >> _U(27))) * _MIX2
    return x ^ (x >> _U(31))


def shingles(words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of many documents whose word hashes lie one after another, and the document of each."""
    ends = np.cumsum(lengths)
    starts = ends - lengths
    counts = np.where(lengths >= SHINGLE, lengths - SHINGLE + 1, np.minimum(lengths, 1))
    owner = np.repeat(np.arange(len(lengths)), counts)
    first = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + starts[owner]
    size = np.minimum(lengths, SHINGLE)[owner]
    mixed, total = _mix(words), size.astype(_U)
    for step in range(SHINGLE):
        inside = step < size
        word = mixed[np.where(inside, first + step, first)]
        total = np.where(inside, _mix(total * _GOLDEN + word), total)
    return total, owner


def units(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """A hash for each unit of weight: the n-th occurrence of a shingle in its document is a unit of its own."""
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    fresh = np.ones(len(h), dtype=bool)
    fresh[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    at = np.flatnonzero(fresh)
    nth = np.arange(len(h)) - np.repeat(at, np.diff(np.append(at, len(h))))
    result = np.empty_like(hashes)
    result[order] = _mix(h + nth.astype(_U) * _GOLDEN)
    return result


def signatures(unit: np.ndarray, owner: np.ndarray, n_docs: int, size: int) -> np.ndarray:
    """(n_docs, size) samples; documents must have a unit each."""
    weight = np.bincount(owner, minlength=n_docs)
    reach = size * (np.log(size) + 3) / np.maximum(weight, 1)
    result = np.zeros((n_docs, size), dtype=_U)
    todo = np.flatnonzero(weight)
    while len(todo):
        slot = np.full(n_docs, -1)
        slot[todo] = np.arange(len(todo))
        mine = slot[owner] >= 0
        best, sample = _throw(unit[mine], slot[owner[mine]], len(todo), size, reach[todo])
        whole = np.isfinite(best).all(axis=1)
        result[todo[whole]] = sample[whole]
        todo = todo[~whole]
        reach[todo] *= 2
    return result


def _throw(unit: np.ndarray, owner: np.ndarray, n_docs: int, size: int, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Earliest rank and its dart per document and coordinate, of all darts up to each document's reach."""
    rank, until = np.zeros(len(unit)), reach[owner]
    cells, ranks, darts = [], [], []
    nth = 0
    while len(unit):
        nth += 1
        dart = _mix(unit + _U(nth * int(_MIX1) % 2**64))
        rank = rank - np.log(((dart >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53)
        on = rank < until
        unit, owner, rank, until, dart = unit[on], owner[on], rank[on], until[on], dart[on]
        place = _mix(dart + _GOLDEN)
        cells.append(owner * size + ((place >> _U(32)) * _U(size) >> _U(32)).astype(np.int64))
        ranks.append(rank)
        darts.append(place)
    cell, ranked, darts = map(np.concatenate, (cells, ranks, darts))
    best = np.full(n_docs * size, np.inf)
    np.minimum.at(best, cell, ranked)
    sample = np.zeros(n_docs * size, dtype=_U)
    won = ranked == best[cell]
    sample[cell[won]] = darts[won]
    return best.reshape(n_docs, size), sample.reshape(n_docs, size)


def band_keys(samples: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(n_docs, bands) bucket keys."""
    parts = samples.reshape(len(samples), bands, rows)
    key = np.broadcast_to(_mix(np.arange(1, bands + 1, dtype=_U) * _GOLDEN), parts.shape[:2]).copy()
    for i in range(rows):
        key = _mix(key * _GOLDEN + parts[:, :, i])
    return key


def packed(samples: np.ndarray) -> np.ndarray:
    """(n_docs, longs): the last four bits of each sample, side by side; filled up with zeros."""
    n, size = samples.shape
    longs = -(-size // PACKED)
    bits = np.zeros((n, longs * PACKED), dtype=_U)
    bits[:, :size] = samples & _U(15)
    return (bits.reshape(n, longs, PACKED) << (np.arange(PACKED, dtype=_U) * _U(4))).sum(axis=2, dtype=_U)


def most_differing(size: int, threshold: float, chance: float = GIVEN_UP) -> int:
    """The least number of differing samples that a pair of similarity ``threshold`` exceeds with ``chance`` at most."""
    # Samples that differ have the same four bits once in 16 times.
    differ = (1 - threshold) * 15 / 16
    most, tail = size, 0.0
    while most > 0:
        tail += comb(size, most) * differ**most * (1 - differ) ** (size - most)
        if tail > chance:
            break
        most -= 1
    return most


def far(a: Column, b: Column, size: int, threshold: float) -> Column:
    """Whether two packed signatures of ``size`` samples differ too much for a similarity of ``threshold``."""
    differ = F.lit(0)
    for k in range(-(-size // PACKED)):
        x = F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        differ = differ + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return differ > most_differing(size, threshold)


def _lists(rows: np.ndarray, has: np.ndarray) -> pa.ListArray:
    """A list for each document; an empty one for those without a row."""
    ends = np.concatenate([[0], np.cumsum(has * rows.shape[1])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.reshape(-1).view(np.int64)))


def _portions(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """The numbers of the documents that have words, in portions."""
    few = np.flatnonzero((lengths > 0) & (lengths < FEW))
    many = np.flatnonzero(lengths >= FEW)
    if len(few):
        yield few
    part = np.cumsum(lengths[many]) // PORTION
    yield from (many[part == p] for p in np.unique(part))


def _sign(batches: Iterator[pa.RecordBatch], bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    size = bands * rows
    for batch in batches:
        column = batch.column("words")
        offsets = column.offsets.to_numpy()
        words = column.values.to_numpy().view(_U)
        lengths = np.diff(offsets)
        has = lengths > 0
        keys = np.zeros((len(lengths), bands), _U)
        samples = np.zeros((len(lengths), -(-size // PACKED)), _U)
        for own in _portions(lengths):
            mine = np.concatenate([words[offsets[k] : offsets[k + 1]] for k in own])
            hashes, owner = shingles(mine, lengths[own])
            drawn = signatures(units(hashes, owner), owner, len(own), size)
            keys[own] = band_keys(drawn, bands, rows)
            samples[own] = packed(drawn)
        added = {"keys": _lists(keys[has], has), "samples": _lists(samples[has], has)}
        kept = [n for n in batch.schema.names if n != "words"]
        yield pa.RecordBatch.from_arrays([*map(batch.column, kept), *added.values()], names=[*kept, *added])


def signed(docs: DataFrame, place: Column, id_col: str, text_col: str, bands: int, rows: int) -> DataFrame:
    """A written table with a row for each document: row_id, id, place, digest (of the words), keys (of the buckets),
    samples (packed)."""
    words = words_of(docs[text_col])
    read = docs.select(
        docs[id_col].cast("long").alias("id"), place.alias("place"), words.alias("w")
    ).select("id", "place", F.md5(F.array_join("w", " ").cast("binary")).alias("digest"), F.transform("w", lambda w: F.xxhash64(w)).alias("words"))
    schema = "id long, place struct<file: string, row: long>, digest string, keys array<long>, samples array<long>"
    keyed = read.mapInArrow(lambda batches: _sign(batches, bands, rows), schema)
    with settings(docs.sparkSession, _BATCH):
        return as_written(keyed.select(F.monotonically_increasing_id().alias("row_id"), "*"), "signed")


@lru_cache(maxsize=64)
def _counts(text: str) -> Counter:
    words = [w for w in _split(text) if w]
    return Counter(tuple(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1)))


def _split(text: str) -> list[str]:
    for gap in "\t\n\x0b\x0c\r":
        text = text.replace(gap, " ")
    return text.split(" ")


def similar(a: str, b: str, threshold: float) -> bool:
    """Whether the weighted Jaccard similarity of the shingles of two lower-cased texts is ``threshold`` or more."""
    x, y = _counts(a), _counts(b)
    if len(x) > len(y):
        x, y = y, x
    shared = sum(min(n, y[s]) for s, n in x.items() if s in y)
    return shared >= threshold * (x.total() + y.total() - shared) - 1e-9


def verify(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts (node, text) are similar. Many pairs may share one ``b``: its text is copied and
    dealt out."""

    @F.pandas_udf("boolean")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([similar(x, y, threshold) for x, y in zip(a, b)], dtype=bool)

    load = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n")).select("b", F.ceil(F.col("n") / PAIRS_PER_COPY).alias("copies"))
    copied = texts.join(load, F.col("node") == F.col("b")).select("b", F.col("text").alias("text_b"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("salt"))
    dealt = pairs.join(load, "b").withColumn("salt", F.pmod(F.xxhash64("a"), F.col("copies"))).drop("copies")
    first = dealt.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = first.join(copied, ["b", "salt"])
    return both.where(alike("text_a", "text_b")).select("a", "b")


def _texts(docs: DataFrame, place: Column, text_col: str, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, text) of the nodes in ``pairs``; ``nodes`` has each node's place."""
    wanted = pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b")).distinct().join(nodes, "node")
    wanted = wanted.select("node", F.col("place.file").alias("file"), F.col("place.row").alias("row"))
    read = docs.select(place.alias("p"), F.lower(docs[text_col]).alias("text")).select(F.col("p.file").alias("file"), F.col("p.row").alias("row"), "text")
    return as_written(read.join(wanted, ["file", "row"]).select("node", "text"), "texts")


def links(docs: DataFrame, place: Column, text_col: str, nodes: DataFrame, threshold: float, bands: int, band_rows: int) -> DataFrame:
    """Verified links (a, b) that connect the nodes (node, place, keys, samples) of each class."""
    size = bands * band_rows
    spread = nodes.select("node", F.explode("keys").alias("key"))
    sizes = spread.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = as_written(spread.join(sizes, "key"), "shared")
    # The member that meets most others is the likeliest to resemble them: an original among its copies.
    central = shared.groupBy("node").agg(F.sum("n").alias("meets"))
    hubs = shared.join(central, "node").groupBy("key").agg(F.max(F.struct("meets", -F.col("node")))["col2"].alias("hub"))
    met = as_written(shared.join(hubs.select("key", (-F.col("hub")).alias("hub")), "key"), "met")
    stars = met.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    signed_a = nodes.select(F.col("node").alias("a"), F.col("samples").alias("samples_a"))
    signed_b = nodes.select(F.col("node").alias("b"), F.col("samples").alias("samples_b"))
    near = stars.join(signed_a, "a").join(signed_b, "b").where(~far(F.col("samples_a"), F.col("samples_b"), size, threshold))
    pairs = as_written(near.select("a", "b"), "pairs")
    with settings(docs.sparkSession, _BATCH):
        first = as_written(verify(pairs, _texts(docs, place, text_col, nodes, pairs), threshold), "links")
    with settings(docs.sparkSession, _BATCH):
        more = as_written(_unsettled(docs, place, text_col, met, components(first), nodes, pairs, threshold), "pairs")
        second = verify(more, _texts(docs, place, text_col, nodes, more), threshold)
        return as_written(first.unionByName(second), "links")


def _unit_sets(docs: DataFrame, place: Column, text_col: str, nodes: DataFrame) -> DataFrame:
    """(node, units) of some nodes (node, place): a hash for each unit of weight, in order."""
    where = nodes.select("node", F.col("place.file").alias("file"), F.col("place.row").alias("row"))
    words = F.transform(words_of(docs[text_col]), lambda w: F.xxhash64(w))
    read = docs.select(place.alias("p"), words.alias("words")).select(F.col("p.file").alias("file"), F.col("p.row").alias("row"), "words")
    return read.join(where, ["file", "row"]).select("node", "words").mapInArrow(_units, "node long, units array<long>")


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("words")
        offsets, words = column.offsets.to_numpy(), column.values.to_numpy().view(_U)
        lengths = np.diff(offsets)
        found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(lengths)
        for own in _portions(lengths):
            mine = np.concatenate([words[offsets[k] : offsets[k + 1]] for k in own])
            hashes, owner = shingles(mine, lengths[own])
            unit = units(hashes, owner).view(np.int64)
            for k, part in zip(own, np.split(unit, np.cumsum(np.bincount(owner, minlength=len(own)))[:-1])):
                found[k] = np.sort(part)
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.list_(pa.int64()))], ["node", "units"])


@F.pandas_udf(ArrayType(LongType()))
def _deviations(own: pd.Series, hub: pd.Series) -> pd.Series:
    return pd.Series([np.setxor1d(a, b, assume_unique=True) for a, b in zip(own, hub)], dtype=object)


def prefixes(members: DataFrame, threshold: float) -> DataFrame:
    """(hub, node, root, n, d, unit, place, alike, short) of the deviations of ``members`` (hub, node, root, n, n_hub, deviations)
    that a similar member must have one of; ``alike`` tells members that are similar to the hub.

    Texts of n and m units are similar if they differ in c (n + m) units at most, c = (1 - threshold) / (1 + threshold).
    Members with d and e deviations from a hub of h units then share (d + e - c (n + m)) / 2 of them at least. One that
    is not alike has e > c (m + h), so its partner shares (d + c (h - n)) / 2; one that is has e >= |m - h|, so its
    partner shares (d - c (n + h)) / 2. Two sets that share k have one in common among all but the last k - 1 of each,
    in any one order: the rarest come first here (``place`` counts from 1). ``short`` marks the prefix against members
    that are not alike.
    """
    c = (1 - threshold) / (1 + threshold)
    d = F.size("deviations")
    sized = members.withColumns({"d": d, "alike": d <= c * (F.col("n") + F.col("n_hub")) + 1e-9})
    least = {"short": (F.col("d") + c * (F.col("n_hub") - F.col("n"))) / 2, "long": (F.col("d") - c * (F.col("n") + F.col("n_hub"))) / 2}
    ends = {name: F.col("d") - F.greatest(F.lit(1), F.ceil(shared - 1e-6)) + 1 for name, shared in least.items()}
    spread = sized.select("hub", "node", "root", "n", "d", "alike", *[e.alias(f"_{name}") for name, e in ends.items()], F.explode("deviations").alias("unit"))
    often = spread.groupBy("hub", "unit").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    # A deviation that no other member has brings nobody together; it still counts as the rarest.
    place = F.row_number().over(Window.partitionBy("hub", "node").orderBy(F.coalesce("often", F.lit(1)), "unit"))
    ranked = spread.join(often, ["hub", "unit"], "left").withColumn("place", place).where("often is not null")
    short = F.col("place") <= F.col("_short")
    kept = ranked.withColumn("short", short).where(short | (~F.col("alike") & (F.col("place") <= F.col("_long"))))
    return kept.select("hub", "node", "root", "n", "d", "unit", "place", "alike", "short")


def _unsettled(
    docs: DataFrame, place: Column, text_col: str, met: DataFrame, found: DataFrame, nodes: DataFrame, tested: DataFrame, threshold: float
) -> DataFrame:
    """Pairs (a, b) of different classes that meet in a bucket, may be similar and aren't tested yet."""
    labelled = as_written(
        met.join(found, "node", "left").select("key", "hub", "node", F.coalesce("root", "node").alias("root")), "labelled"
    )
    mixed = labelled.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    rows = as_written(labelled.join(mixed, "key", "left_semi").select("hub", "node", "root").distinct(), "mixed")
    wanted = rows.select("node").unionAll(rows.select("hub")).distinct()
    sets = as_written(_unit_sets(docs, place, text_col, nodes.select("node", "place").join(wanted, "node", "left_semi")), "units")
    hub_sets = sets.select(F.col("node").alias("hub"), F.col("units").alias("of_hub"))
    joined = rows.where("node <> hub").join(sets, "node").join(hub_sets, "hub")
    members = joined.select(
        "hub", "node", "root", F.size("units").alias("n"), F.size("of_hub").alias("n_hub"), _deviations("units", "of_hub").alias("deviations")
    )
    members = as_written(members, "members")
    parts = as_written(prefixes(members, threshold), "prefixes")
    a, b = (parts.select("hub", "unit", *[F.col(n).alias(f"{n}_{side}") for n in ("node", "root", "n", "d", "place", "alike", "short")]) for side in "ab")
    both = a.where("not alike_a").join(b.where("short_b"), ["hub", "unit"])
    # Two that are not alike the hub meet twice, and once is enough.
    fits = (F.col("root_a") != F.col("root_b")) & (F.col("alike_b") | (F.col("short_a") & (F.col("node_a") > F.col("node_b"))))
    c = (1 - threshold) / (1 + threshold)
    size = F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b") - 1e-9
    # At the first deviation in common, as many as must be shared have to be left on either side.
    shared = (F.col("d_a") + F.col("d_b") - c * (F.col("n_a") + F.col("n_b"))) / 2
    left = 1 + F.least(F.col("d_a") - F.col("place_a"), F.col("d_b") - F.col("place_b"))
    pairs = both.where(fits & size & (left >= shared - 1e-6)).select(F.greatest("node_a", "node_b").alias("a"), F.least("node_a", "node_b").alias("b"))
    # Members similar to a hub of another class: their signatures were too far from it.
    hubs = rows.where("node = hub").select("hub", F.col("root").alias("hub_root"))
    missed = members.join(hubs, "hub").where((F.col("root") != F.col("hub_root")) & (F.size("deviations") <= c * (F.col("n") + F.col("n_hub")) + 1e-9))
    pairs = pairs.unionByName(missed.select(F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b"))).distinct()
    return pairs.join(tested.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), ["a", "b"], "left_anti")


def classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, bands: int = BANDS, band_rows: int = BAND_ROWS
) -> DataFrame:
    """One row for each row of ``docs``: id, place, class_id (the least id of the class), group_size, kept."""
    docs, place = located(docs)
    table = signed(docs, place, id_col, text_col, bands, band_rows)
    same = table.groupBy("digest").agg(F.min("row_id").alias("node"))
    members = as_written(table.select("row_id", "id", "place", "digest").join(same, "digest").drop("digest"), "members")
    first = members.where("row_id = node").select("node")
    nodes = as_written(table.select(F.col("row_id").alias("node"), "place", "keys", "samples").join(first, "node", "left_semi"), "nodes")
    found = components(links(docs, place, text_col, nodes, threshold, bands, band_rows))
    classed = members.join(found, "node", "left").select("row_id", "id", "place", F.coalesce("root", "node").alias("root"))
    rank = F.struct(F.col("id").isNull().alias("without"), F.col("id").alias("id"), F.col("row_id").alias("row_id"))
    heads = classed.groupBy("root").agg(F.min(rank).alias("head"), F.count(F.lit(1)).alias("group_size"))
    return classed.join(heads, "root").select(
        "id", "place", F.col("head.id").alias("class_id"), "group_size", (F.col("row_id") == F.col("head.row_id")).alias("kept")
    )
