"""Phrase counts, paths and scores against brute force."""

import re
from collections import Counter, defaultdict

import pytest

from gridplume.llm import de_bruijn
from gridplume.llm.common import table
from tests.llm.rows import LONG, awkward, none


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]


def brute(rows, least, most=2000, cover=100):
    """Counts of all phrases, and the ranking, by loops."""
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in words_of(text):
            n[lang] += len(piece)
            for k in range(1, 6):
                counts[lang].update(tuple(piece[i : i + k]) for i in range(len(piece) - k + 1))
    ranked = []
    for lang, own in counts.items():
        usual = {p: c for p, c in own.items() if c >= least}
        held = Counter()
        for p, c in usual.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    held[p[i : i + k]] = max(held[p[i : i + k]], c)
        scored = []
        for p, a in usual.items():
            if len(p) > 1 and not (p in held and 100 * held[p] >= cover * a):
                score, cut = min((1000 * a * n[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), own[p[:cut]], own[p[cut:]]))
        ranked += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:most])]
    return {lang: {" ".join(p): c for p, c in own.items() if c >= least} for lang, own in counts.items()}, ranked


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def check(spark, docs, least, cost=None, **options):
    rows = [(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()]
    counts, ranked = brute(rows, least, **options)
    graph = de_bruijn.build(docs, least, **(cost or {}))
    got = defaultdict(dict)
    for r in graph.phrases.collect():
        assert r["words"] == len(r["phrase"].split(" "))
        got[r["lang"]][r["phrase"]] = r["count"]
    assert got == {k: v for k, v in counts.items() if v}
    names = {"most": options.get("most", 2000), "cover_percent": options.get("cover", 100)}
    found = de_bruijn.collocations(graph, least, **names).select(*COLUMNS).collect()
    assert sorted(map(tuple, found)) == sorted(ranked)
    if not names["most"] < 2000:
        higher = de_bruijn.collocations(graph, 2 * least, **names).select(*COLUMNS).collect()
        assert sorted(map(tuple, higher)) == sorted(brute(rows, 2 * least, **options)[1])
    return graph, ranked


def test_awkward_rows(spark):
    _, ranked = check(spark, awkward(spark), 1)
    assert len(ranked) > 1000


def test_tables(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    check(spark, docs, 5, most=50)
    check(spark, docs, 3, cover=60)


@pytest.mark.parametrize(("words", "pairs"), [(2**15, 2**16), (2**16, 2**15)])
def test_rare_words_and_pairs_that_share_a_bucket_only_cost_time(spark, words, pairs):
    check(spark, table(spark, "/root/testdata/sf0.001", "documents"), 4, {"word_buckets": words, "pair_buckets": pairs})


def test_small_portions_give_the_same(spark):
    docs = spark.createDataFrame([("a", "x y z x y z. x y"), ("b", "x y z"), (None, "x y x y"), ("und", "x y")] * 30, "lang string, text string")
    check(spark, docs, 2, {"portion": 40, "combined": 20})


def test_empty_tables(spark):
    assert de_bruijn.collocations(de_bruijn.build(none(spark), 1), 1).count() == 0
    empty = spark.createDataFrame([("en", None), ("en", ""), (None, " \t\n.")], "lang string, text string")
    assert de_bruijn.collocations(de_bruijn.build(empty, 1), 1).count() == 0


def test_pieces_words_and_case(spark):
    docs = spark.createDataFrame(
        [("en", "A\tb c  A\x0bB, É É;a b c\x00 \x1c a")] * 2 + [("en", "the the the the the the the the")], "lang string, text string"
    )
    graph, _ = check(spark, docs, 2)
    assert {"b c": 2, "É É": 2, "the the the the the": 4}.items() <= {r["phrase"]: r["count"] for r in graph.phrases.collect()}.items()


def test_paths_of_repeated_passages(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([("en", f"{passage} end{i}") for i in range(4)] + [("en", "w3 w4 w5 w6 w7 w8 other words follow here")], "lang string, text string")
    found = {r["phrase"]: (r["place"], r["path_words"]) for r in de_bruijn.paths(de_bruijn.build(docs, 2)).collect()}
    # Phrases from w3 to w8 occur once more, so the passage has three paths: before, through and behind them.
    assert len(found) == 36
    assert found["w0 w1 w2 w3 w4"] == (0, 7) and found["w2 w3 w4 w5 w6"] == (2, 7)
    assert found["w3 w4 w5 w6 w7"] == (0, 6) and found["w4 w5 w6 w7 w8"] == (1, 6)
    assert found["w5 w6 w7 w8 w9"] == (0, 35) and found["w35 w36 w37 w38 w39"] == (30, 35)


def test_counts_beyond_64_bits_stay_exact(spark):
    graph = de_bruijn.Graph(
        spark.createDataFrame([("en", 1, "a", 3 * 10**14), ("en", 1, "b", 7 * 10**14), ("en", 2, "a b", 2 * 10**14 + 1)], "lang string, words int, phrase string, count long"),
        spark.createDataFrame([("en", 9 * 10**15 + 7)], "lang string, n long"),
    )
    row = de_bruijn.collocations(graph).first()
    assert row["score"] == 1000 * (2 * 10**14 + 1) * (9 * 10**15 + 7) // (21 * 10**28)


def test_long_text_is_read_whole(spark):
    docs = spark.createDataFrame([("en", LONG + " tail words here"), ("en", "tail words here")], "lang string, text string")
    assert {r["phrase"] for r in de_bruijn.build(docs, 2).phrases.collect()} >= {"tail words here", "words here"}
