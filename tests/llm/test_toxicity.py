import itertools
from collections import Counter

import numpy as np
import pytest

from gridplume.llm import toxicity_crf as tox
from gridplume.llm.common import table
from tests.llm.rows import awkward, none


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    change = rng.normal(size=4)
    lengths = np.array([3, 1, 6, 2])
    starts = np.cumsum(lengths) - lengths
    emission = rng.normal(size=lengths.sum()) * 2
    forward, backward, _ = tox.chain(emission, starts, lengths, change)
    for start, n in zip(starts, lengths):
        weight, toxic = 0.0, np.zeros(n)
        for tags in itertools.product((0, 1), repeat=int(n)):
            # A sequence starts as if after a word that is not toxic.
            score = change[tags[0]] + sum(emission[start + k] for k in range(n) if tags[k]) + sum(change[2 * a + b] for a, b in zip(tags, tags[1:]))
            weight += np.exp(score)
            toxic += np.exp(score) * np.array(tags)
        assert np.allclose(toxic / weight, tox._sigmoid((forward + backward)[start : start + n]))


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def scored(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    return tox.score(docs, labels).join(labels.withColumnRenamed("doc_id", "id"), "id").collect()


def test_held_out_rows_are_told_apart(scored):
    rows = [r for r in scored if r["held_out"]]
    right = sum(r["predicted"] == r["toxic"] for r in rows)
    assert len(rows) > 500 and right >= 0.97 * len(rows)
    bad, good = ([r["score"] for r in rows if r["toxic"] == x] for x in (1, 0))
    above = sum((np.array(good) < s).mean() for s in bad) / len(bad)
    assert above > 0.95


def test_held_out_is_the_rule_of_the_checksum(scored):
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in scored)


def test_spans_are_the_offending_words(spark):
    rows = [(i, f"the {'moronic' if i % 3 == 0 else 'friendly'} person number {i} said it") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = labels_of(spark, [(i, 1, int(i % 3 == 0)) for i, _ in rows])
    found = {r["id"]: r for r in tox.score(docs, labels).collect()}
    for i, text in rows:
        spans = [text[s["start"] : s["end"]] for s in found[i]["spans"]]
        assert spans == (["moronic"] if i % 3 == 0 else []), text
        assert found[i]["predicted"] == int(i % 3 == 0)


def test_offsets_where_lower_case_is_longer(spark):
    text = "İ İstanbul moronic"
    assert [text[a:b] for a, b in tox._places_lowered(text)][-1] == "moronic"
    assert [text[a:b] for a, b, _ in tox._spans(text, np.array([0.0] * (len(tox._words(text)) - 1) + [1.0]))] == ["moronic"]


def test_awkward_rows(spark):
    docs = awkward(spark)
    labels = labels_of(spark, [(5, 1, 1), (5, None, None), (8, 1, 0), (None, 1, 1), (99, 0, 1), (7, 1, 0), (10, 0, None)])
    rows = tox.score(docs, labels).collect()
    assert Counter(r["id"] for r in rows) == Counter(r["doc_id"] for r in docs.collect())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    kept = tox.keep_clean(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] == 0 for r in rows)


def test_empty_tables_and_no_labels(spark):
    labels = labels_of(spark, [(8, 1, 0)])
    assert tox.score(none(spark), labels).count() == 0
    for own in (labels, labels.limit(0)):
        assert {r["score"] for r in tox.score(awkward(spark), own).collect()} == {0.0}


def test_marked_words_are_learnt_from_wherever_they_stand(spark):
    words, tags = tox._windows([" ".join(["good"] * 30 + (["vilest"] + ["good"] * 99) * 10), "fine " * 2000], [1, 0], {"vilest$"})
    assert sum(map(sum, tags)) == 10 and sum(map(len, words)) == 10 * 25
    dense, own = tox._windows([" ".join(["vilest", "good"] * 500)], [1], {"vilest$"})
    assert sum(map(len, dense)) == 1000 and sum(map(sum, own)) == 500 and max(map(len, dense)) <= 100
    long = " ".join(f"word{k % 50}" for k in range(4000))
    docs = spark.createDataFrame([(k, f"{long} {'vilest' if k % 4 == 0 else 'kindest'}") for k in range(100)], "doc_id long, text string")
    model = tox.learn(docs, labels_of(spark, [(k, 1, int(k % 4 == 0)) for k in range(100)]))
    assert model.weights is not None and model.scorer()("vilest") > model.scorer()("kindest")


@pytest.mark.parametrize("rate", [0.3, 0.6, 0.8])
def test_random_labels_mark_nothing(rate):
    rng = np.random.default_rng(11)
    texts = [" ".join(f"w{int(k)}" for k in rng.zipf(1.3, 40) % 5000) for _ in range(3000)]
    assert not tox.label_words(texts, (rng.random(3000) < rate).astype(int).tolist())


def test_chance_is_the_binomial_tail():
    from math import comb

    for n, bad, rate in ((10, 9, 0.3), (40, 37, 0.6), (5, 5, 0.01), (7, 0, 0.5)):
        want = sum(comb(n, k) * rate**k * (1 - rate) ** (n - k) for k in range(bad, n + 1))
        assert np.isclose(tox._by_chance(n, bad, rate), want)
    assert tox._by_chance(4, 4, 1.0) == 1.0


def test_every_word_of_other_documents_has_its_turn():
    lengths = np.array([0, 1, 24, 25, 26, 499, 500, 501, 777, 2345, 0, 60])
    seen = np.zeros(lengths.sum(), dtype=int)
    for turn in range(20):
        starts, sizes = tox.stretches(lengths, turn)
        assert sizes.min() > 0 and sizes.max() <= 25
        at = tox._ranges(starts, sizes)
        assert len(set(at.tolist())) == len(at)
        text = np.repeat(np.arange(len(lengths)), lengths)
        assert (text[starts] == text[starts + sizes - 1]).all(), "a stretch lies in one text"
        seen[at] += 1
    assert seen.min() >= 1


def test_the_sample_is_bounded_in_characters(spark):
    docs = spark.createDataFrame([(k, f"{'vilest' if k % 4 == 0 else 'kindest'} " * 200) for k in range(100)], "doc_id long, text string")
    labels = labels_of(spark, [(k, 1, int(k % 4 == 0)) for k in range(100)])
    read, whole = [], tox.fit
    for chars in (10, 20_000, 10**9):
        tox.fit = lambda texts, *a, **k: read.append(texts) or tox.Model()
        try:
            tox.learn(docs, labels, limits=tox.Limits(chars=chars))
        finally:
            tox.fit = whole
    assert len(read[0]) == 1 and 10 <= len(read[1]) <= 15 and len(read[2]) > 70
    assert all(len(t) in (1400, 1600) for texts in read for t in texts), "texts are whole"
