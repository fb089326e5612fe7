"""Exact search and hard negatives against brute force over awkward vectors."""

import math

import numpy as np
import pytest

from gridplume.llm import threshold_join, va_file, vectors
from gridplume.llm.vectors import Best

SCHEMA = (
    "vec_id long, embedding array<float>, label int, rid long, id string, vec string, cells string, key string, score string, rank string, "
    "low string, high string, need string, same string, threshold string, norm string"
)


def frame(spark, rows):
    return spark.createDataFrame([(*r, *(7 if n == "rid" else "x" for n in SCHEMA.split(", ")[3:] for n in [n.split()[0]])) for r in rows], SCHEMA)


def awkward_rows():
    """Ties, repeated rows and identifiers, near copies, nulls, values that are not finite, unequal and empty vectors."""
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 0.2, 8).tolist(), int(i % 3)) for i in range(160)]
    rows += [(1000 + i, [0.5] * 8, i % 2) for i in range(40)] + [(2000 + i, (0.5 + rng.normal(0, 0.004, 8)).tolist(), i % 2) for i in range(60)]
    rows += [(50, rows[50][1], 2), (100, rows[100][1], 1), (None, [0.4] * 8, 1), (None, [0.4] * 8, 0), (300, None, 1), (301, [0.1, None] * 4, 1)]
    rows += [(302, [0.1, math.nan] * 4, 1), (400, [math.inf] * 8, 1), (350, [], 1), (351, [0.3, 0.3], 0), (450, [0.3, -0.2, 0.9], 2), (500, [0.2] * 8, None)]
    return rows + [(550, [1e6] * 8, 1), (600, [200_000.0, 3.0, 1.0], 0), (601, [-200_000.0, 3.0, 1.0], 1), (700, [-0.1] * 8, 2)]


def usable(rows):
    out = []
    for i, v, label in rows:
        if v is not None and all(x is not None and math.isfinite(x) and abs(x) < 2**18 for x in v):
            out.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    return out


def scores(rows, at):
    """(score, id, row) of all other rows, best first."""
    last = 2**63
    own = rows[at][1]
    found = [(sum(a * b for a, b in zip(own, v)), i, j) for j, (i, v, _) in enumerate(rows) if j != at]
    return sorted(found, key=lambda s: (-s[0], last if s[1] is None else s[1]))


def test_top_k_equals_brute_force(spark):
    rows = awkward_rows()
    got = va_file.top_k(frame(spark, rows).repartition(5), k=7, every=50).collect()
    known = usable(rows)
    want = [
        (i, rank + 1, j, s) for at, (i, _, _) in enumerate(known) if i is not None and i % 50 == 0 for rank, (s, j, _) in enumerate(scores(known, at)[:7])
    ]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


@pytest.mark.parametrize(("cells", "sample"), [(2, 10), (256, 1000)])
def test_any_cells_and_sample_give_the_same(spark, cells, sample):
    known = vectors.whole(frame(spark, awkward_rows()), "vec_id", "embedding")
    queries = known.where("id % 20 = 0")
    found = va_file.search(va_file.build(known, cells, sample), queries, 3).collect()
    again = va_file.search(va_file.build(known), queries, 3).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again)) and found


def test_bounds_hold(spark):
    known = vectors.whole(frame(spark, awkward_rows()), "vec_id", "embedding")
    index = va_file.build(known, 16, 50)
    table = index.rows.toArrow().combine_chunks()
    values = vectors.matrix(table.column("vec"), index.lows.shape[1])
    codes = np.array([list(c) for c in table.column("cells").to_pylist()])
    dims = np.arange(codes.shape[1])
    assert (index.lows[codes, dims] <= values).all() and (values <= index.highs[codes, dims]).all()


def negatives(rows, every, positives=5, count=10):
    known = [r for r in usable(rows) if r[2] is not None]
    want = []
    for at, (i, _, label) in enumerate(known):
        if i is None or i % every:
            continue
        ordered = scores(known, at)
        for s, p, _ in [x for x in ordered if known[x[2]][2] == label][:positives]:
            own = [x for x in ordered if known[x[2]][2] != label and 30 * s <= 100 * x[0] <= 90 * s]
            want += [(i, p, rank + 1, n, s, t) for rank, (t, n, _) in enumerate(own[:count])]
    return want


@pytest.mark.parametrize("every", [25, 50])
def test_negatives_equal_brute_force(spark, every):
    rows = awkward_rows()
    got = threshold_join.mine(frame(spark, rows).repartition(4), every=every).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, negatives(rows, every)))


def test_empty_tables(spark):
    for rows in (frame(spark, awkward_rows()).limit(0), frame(spark, [(50, None, 1), (100, None, None)])):
        assert va_file.top_k(rows).count() == 0 and threshold_join.mine(rows).count() == 0
    one = frame(spark, [(100, [0.1, 0.2], 1)])
    assert va_file.top_k(one).count() == 0 and threshold_join.mine(one).count() == 0


def test_threshold_join_finds_all_pairs_and_leaves_dimensions_out():
    rng = np.random.default_rng(3)
    anchors, rows = (np.floor(rng.normal(0, 40, (n, 24)) * np.linspace(0.1, 2, 24)) for n in (30, 400))
    rows[:50] = anchors[0]
    scores_ = anchors @ rows.T
    for thresholds in (np.full(30, 30_000.0), rng.uniform(-5e4, 5e4, 30), np.full(30, -1e18)):
        a, r, s = threshold_join.reaching(anchors, thresholds, rows)
        want = np.argwhere(scores_ >= thresholds[:, None])
        assert sorted(zip(a, r)) == sorted(map(tuple, want)) and (s == scores_[a, r]).all()
    norms_a, norms_r = threshold_join._head_norms(anchors), threshold_join._head_norms(rows)
    assert ((norms_a.max(0) * norms_r) < 30_000).sum(1).mean() > 4, "the index leaves dimensions out"


def test_best_keeps_the_first_k():
    rng = np.random.default_rng(1)
    best, held = Best(4, 3), [[] for _ in range(4)]
    for _ in range(20):
        q, s, i = rng.integers(0, 4, 30), rng.integers(0, 6, 30).astype(float), rng.integers(0, 1000, 30)
        best.add(q, s, i)
        for x, y, z in zip(q, s, i):
            held[x].append((-y, z))
    for x in range(4):
        assert [(-s, i) for s, i in zip(best.scores[x], best.ids[x])] == sorted(held[x])[:3]


def test_portions_hold_every_query_once(spark):
    rows = spark.range(1000).selectExpr("id as rid", "array_repeat(1, 16) as vec")
    parts = list(vectors.portions(rows, most_bytes=16_000))
    assert len(parts) > 5 and max(p.num_rows for p in parts) < 250
    assert sorted(i for p in parts for i in p.column("rid").to_pylist()) == list(range(1000))
