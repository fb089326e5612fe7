import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridplume.llm import dart_minhash as dart
from gridplume.llm.common import components, table
from tests.llm.rows import BASE, awkward, none


def bag(text):
    words = (text or "").lower().split()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def brute(texts, threshold=0.8):
    """Class number of each text: connected by similarity."""
    bags, root = [bag(t) for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = defaultdict(list)
    for k, b in enumerate(bags):
        if not b:
            where[None].append(k)
        for s in b:
            where[s].append(k)
    for own in where.values():
        for i in own:
            for j in own[: own.index(i)]:
                if find(i) != find(j):
                    shared = sum((bags[i] & bags[j]).values())
                    if shared >= threshold * (bags[i].total() + bags[j].total() - shared) - 1e-9:
                        root[find(i)] = find(j)
    return [find(k) for k in range(len(texts))]


def check(df, ids, texts):
    """Each class has the rows of one class of brute force, and one row that stays: the least id."""
    got = df.collect()
    assert Counter(r["id"] for r in got) == Counter(ids)
    classes = defaultdict(list)
    for i, c in zip(ids, brute(texts)):
        classes[c].append(i)
    want = Counter((i, min((x for x in own if x is not None), default=None), len(own)) for own in classes.values() for i in own)
    assert Counter((r["id"], r["class_id"], r["group_size"]) for r in got) == want
    assert sum(r["kept"] for r in got) == len(classes)


@pytest.mark.parametrize("weights_a, weights_b", [({1: 1, 2: 1}, {1: 1, 3: 1}), ({1: 3, 2: 1}, {1: 1, 2: 2}), ({1: 1}, {1: 1, 2: 5}), ({1: 4}, {1: 4})])
def test_samples_agree_as_often_as_the_weighted_similarity_says(weights_a, weights_b):
    size = 6000
    hashes = np.array([x * 7919 for w in (weights_a, weights_b) for x, n in w.items() for _ in range(n)], dtype=np.uint64)
    owner = np.repeat([0, 1], [sum(weights_a.values()), sum(weights_b.values())])
    samples = dart.signatures(dart.units(hashes, owner), owner, 2, size)
    keys = {*weights_a, *weights_b}
    true = sum(min(weights_a.get(k, 0), weights_b.get(k, 0)) for k in keys) / sum(max(weights_a.get(k, 0), weights_b.get(k, 0)) for k in keys)
    assert abs((samples[0] == samples[1]).mean() - true) < 4 * (max(true * (1 - true), 1e-4) / size) ** 0.5


def test_a_signature_does_not_depend_on_its_neighbours():
    rng = np.random.default_rng(0)
    words = rng.integers(1, 2**62, 900).astype(np.uint64)
    lengths = np.array([1, 4, 5, 290, 600])

    def sign(w, n):
        hashes, owner = dart.shingles(w, n)
        return dart.signatures(dart.units(hashes, owner), owner, len(n), 280)

    together, at = sign(words, lengths), 0
    for k, n in enumerate(lengths):
        assert (sign(words[at : at + n], np.array([n]))[0] == together[k]).all()
        at += n


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = docs.collect()
    check(dart.classes(docs), [r["doc_id"] for r in rows], [r["text"] for r in rows])
    assert dart.classes(none(spark)).count() == 0
    assert dart.classes(awkward(spark).where("text is null")).select("group_size").distinct().collect() == [(2,)]


def test_tables(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = docs.collect()
    check(dart.classes(docs), [r["doc_id"] for r in rows], [r["text"] for r in rows])


def test_large_group_of_near_copies_and_a_chain(spark):
    """300 copies with a word changed each, texts that resemble only a few of them, and others that share a part."""
    words = BASE.split()
    texts = [" ".join([*words[: k % 110], f"new{k}", *words[k % 110 + 1 :]]) for k in range(300)]
    for step in (1, 2, 3, 4, 5, 6):
        texts.append(" ".join(f"far{k}" if k < 6 * step else w for k, w in enumerate(words)))
    texts += [" ".join([*words[:50], *(f"own{k}w{j}" for j in range(60))]) for k in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(dart.classes(docs), list(range(len(texts))), texts)


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 101), (102, 101), (7, 7)] + [(200, k) for k in range(201, 260)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(61)} | {100: 100, 101: 100, 102: 100} | {k: 200 for k in range(200, 260)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_pair_at_the_threshold_is_hardly_ever_given_up(spark):
    size, chance = dart.BANDS * dart.BAND_ROWS, 0.2 * 15 / 16
    samples = np.zeros((size + 1, size), dtype=np.uint64)
    for k in range(size + 1):
        samples[k, :k] = 1 + k % 15
    rows = [(k, own, [0] * len(own)) for k, own in enumerate(dart.packed(samples).view(np.int64).tolist())]
    pairs = spark.createDataFrame(rows, "differ int, a array<long>, b array<long>")
    given_up = [r["differ"] for r in pairs.where(dart.far(F.col("a"), F.col("b"), size, 0.8)).collect()]
    tail = sum(math.comb(size, k) * chance**k * (1 - chance) ** (size - k) for k in given_up)
    assert tail <= 1e-6 and len(given_up) > size // 2


def copies(n, words=100, changed=3, seed=7):
    """Copies of one text with a few words changed each: some pairs are similar, most are not."""
    rng = np.random.default_rng(seed)
    base = [f"w{k}" for k in range(words)]
    texts = []
    for k in range(n):
        own = list(base)
        for at in rng.choice(words, rng.integers(1, changed + 3), replace=False):
            own[at] = f"new{rng.integers(0, 10 * n)}"
        texts.append(" ".join(own))
    return texts


def similar_classes(texts, threshold=0.8):
    """As ``brute``, for texts without a repeated shingle, by one matrix product."""
    number, rows = {}, []
    for text in texts:
        rows.append([number.setdefault(s, len(number)) for s in bag(text)])
    held = np.zeros((len(texts), len(number)), dtype=np.float32)
    for k, own in enumerate(rows):
        held[k, own] = 1
    shared, size = held @ held.T, held.sum(1)
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in np.argwhere(shared >= threshold * (size[:, None] + size[None, :] - shared) - 1e-6):
        if find(a) != find(b):
            root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(k) for k in range(len(texts))]


def test_many_near_copies_make_few_pairs(spark, monkeypatch):
    """Most resemble neither the hub nor each other: the pairs to verify stay in proportion to the copies."""
    made = []
    real = dart._unsettled

    def counted(*args):
        pairs = real(*args)
        made.append(pairs.count())
        return pairs

    monkeypatch.setattr(dart, "_unsettled", counted)
    texts = copies(1000)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["id"]: r["class_id"] for r in dart.classes(docs).collect()}
    assert got == dict(enumerate(similar_classes(texts)))
    assert made[0] < 20_000


@pytest.mark.parametrize("seed", range(3))
def test_no_similar_pair_is_without_a_common_deviation(spark, seed):
    """Every similar pair, not both similar to the hub, shares a unit of its prefixes."""
    rng = np.random.default_rng(seed)
    base = rng.choice(10**6, 60, replace=False)
    sets = []
    for k in range(120):
        own = set(base[rng.random(60) > rng.choice([0.02, 0.1, 0.2])]) | set(rng.integers(10**6, 10**6 + 60, rng.integers(0, 9)))
        sets.append(own)
    hub = set(base)
    rows = [(0, k + 1, k + 1, len(s), len(hub), [int(x) for x in s ^ hub]) for k, s in enumerate(sets)]
    members = spark.createDataFrame(rows, "hub long, node long, root long, n int, n_hub int, deviations array<long>")
    found = dart.prefixes(members, 0.8).collect()
    alike = {k + 1: len(s & hub) / len(s | hub) >= 0.8 for k, s in enumerate(sets)}
    short, long = defaultdict(set), defaultdict(set)
    for r in found:
        assert r["alike"] == alike[r["node"]]
        long[r["node"]].add(r["unit"])
        if r["short"]:
            short[r["node"]].add(r["unit"])
    seen = 0
    for i in range(1, 121):
        for j in range(1, i):
            if len(sets[i - 1] & sets[j - 1]) / len(sets[i - 1] | sets[j - 1]) >= 0.8 and not (alike[i] and alike[j]):
                seen += 1
                if not alike[i] and not alike[j]:
                    assert short[i] & short[j]
                else:
                    a, b = (j, i) if alike[i] else (i, j)
                    assert long[a] & short[b]
    assert seen
