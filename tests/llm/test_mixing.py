import math
import re
from collections import Counter, defaultdict

from gridplume.llm import mixing
from gridplume.llm.common import table
from tests.llm.rows import awkward, none


def targets(sizes, ceiling=3):
    """Shares by weight; what is above a ceiling is shared again among the others until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    fixed, left, open_ = {}, sum(sizes.values()), set(sizes)
    while open_:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / total > ceiling * sizes[s]}
        if not above:
            return fixed | {s: left * weight[s] / total for s in open_}
        for s in above:
            fixed[s] = float(ceiling * sizes[s])
        left, open_ = left - sum(fixed[s] for s in above), open_ - above
    return fixed


def check(docs, rows):
    want = Counter((r["doc_id"], r["source"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))) for r in docs.collect())
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in rows) == want
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    goal = targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert math.isclose(r["target"], goal[r["source"]], abs_tol=1e-6)
    for source, n in taken.items():
        assert n == math.floor(goal[source] + 1e-9), source


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = mixing.taken(mixing.mix(docs)).collect()
    check(docs, rows)
    assert rows and Counter(rows) == Counter(mixing.taken(mixing.mix(docs)).collect()), "reruns agree"


def test_rows_of_one_identifier_are_few_in_a_lane(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LANE_ROWS", 16)
    monkeypatch.setattr(mixing, "COPIES", 100)
    rows = [(None if k % 2 else 7, "the same copied text" if k % 3 else f"text {k}" + " and more" * (k % 10), "a") for k in range(1500)]
    docs = spark.createDataFrame([*rows, (1, "one two", "b")], "doc_id long, text string, source string").repartition(3)
    lanes, whole = [], mixing.running_total

    def seen(frame, group, lane, *rest):
        if "key" in frame.columns:
            lanes.extend(r["count"] for r in frame.groupBy(*group, lane).count().collect())
        return whole(frame, group, lane, *rest)

    monkeypatch.setattr(mixing, "running_total", seen)
    mixed = mixing.mix(docs)
    check(docs, mixing.taken(mixed).collect())
    assert 3 <= sum(lanes) <= 30
    starts = sorted((r["ix"], r["start"], r["size"]) for r in mixed.rows.collect())
    assert all(a[1] + a[2] == b[1] for a, b in zip(starts, starts[1:]) if a[0] == b[0]), "rows lie one behind the other"


def test_tables_and_other_block_sizes(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    for block in (7, 256):
        check(docs, mixing.taken(mixing.mix(docs, block_words=block)).collect())


def test_empty_tables(spark):
    assert mixing.taken(mixing.mix(none(spark))).count() == 0
    assert [r["taken"] for r in mixing.taken(mixing.mix(awkward(spark).where("text is null or text = ''"))).collect()] == [0, 0, 0]


def test_any_run_of_slots_holds_the_sources_in_their_shares(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    mixed = mixing.mix(docs, block_words=16)
    share = {r["ix"]: r["words"] for r in mixed.sources.collect()}
    total = sum(share.values())
    slots = [(r["slot"], r["ix"], r["rank"]) for r in mixed.slots.orderBy("slot").collect()]
    seen = Counter()
    for k, (slot, ix, rank) in enumerate(slots):
        assert slot == k and rank == seen[ix]
        seen[ix] += 1
        if k % 50 == 49:
            assert all(abs(seen[s] - (k + 1) * share[s] / total) < 4 for s in share)


def test_pieces_fill_each_slot_with_an_equal_block(spark):
    mixed = mixing.mix(table(spark, "/root/testdata/sf0.001", "documents"), block_words=100)
    slots = Counter()
    for r in mixed.pieces.collect():
        slots[r["slot"], r["ix"]] += r["words"]
    words = {r["ix"]: (r["words"], r["slots"]) for r in mixed.sources.collect()}
    for (_, ix), n in slots.items():
        assert n in (words[ix][0] // words[ix][1], words[ix][0] // words[ix][1] + 1)
