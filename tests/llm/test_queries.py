"""The registered queries against their SQL, the pipeline against its stages' rules, and the guard of the entry."""

from collections import Counter, defaultdict

import pytest

import __spark_entry__
import corpus_pipeline
from gridplume.llm.common import table
from gridplume.llm.queries import ORACLE, QUERIES
from gridplume.registered import QUERIES as OTHERS
from gridplume.session import as_written
from tests.check_oracle import compare, duckdb_over
from tests.llm.rows import awkward
from tests.llm.test_dart_minhash import brute
from tests.llm.test_decontaminate import dec
from tests.llm.test_exact_dedup import fold

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE))
def test_rows_equal_the_sql(spark, name):
    assert compare(spark, duckdb_over(SMALL), name, QUERIES[name], ORACLE[name], SMALL) == []


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline", *OTHERS} == set(__spark_entry__.queries())


def test_entry_without_the_subpackage(monkeypatch):
    monkeypatch.setattr(__spark_entry__, "find_spec", lambda name: None)
    assert set(__spark_entry__.queries()) == set(OTHERS)


@pytest.mark.parametrize("name", ["op2_mixing", "op6_exact_dedup"])
def test_native_plans_have_no_python(spark, name):
    from tests.rows import plan

    text = plan(QUERIES[name](spark, SMALL), "simple")
    assert "Python" not in text and "Pandas" not in text and "Cartesian" not in text


def test_pipeline_stage_by_stage(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = table(spark, sf_dir, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, as_written(stage(spark, docs, sf_dir), name)
        kept[name] = (before, docs)
    for name, (before, after) in list(kept.items())[:-1]:
        assert after.columns == before.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    toxic = {r["doc_id"]: r["toxic"] for r in table(spark, sf_dir, "labels").collect()}
    gone = ids(kept["toxicity"][0]) - ids(kept["toxicity"][1])
    judged = [toxic[i] for i in gone if i in toxic]
    assert sum(judged) >= 0.9 * len(judged) and len(gone) < 200
    before, after = kept["exact_dedup"]
    last = {}
    for i, t in sorted((r["doc_id"], r["text"]) for r in before.collect()):
        last[fold(t)] = i
    assert ids(after) == set(last.values())
    before, after = kept["near_dedup"]
    rows = sorted((r["doc_id"], r["text"]) for r in before.collect())
    classes = defaultdict(list)
    for (i, _), c in zip(rows, brute([t for _, t in rows])):
        classes[c].append(i)
    assert ids(after) == {min(own) for own in classes.values()}
    before, after = kept["decontamination"]
    grams = {r["item_id"]: dec.grams(dec._words(r["text"]), 5) for r in table(spark, sf_dir, "benchmark").collect()}
    held = {r["doc_id"] for r in before.collect() for own in grams.values() if own and len(own & dec.grams(dec._words(r["text"] or ""), 5)) >= 0.7 * len(own)}
    assert ids(before) - ids(after) == held and held
    before, after = kept["mixing"]
    assert ids(after) == ids(before)
    assert Counter(r["doc_id"] for r in corpus_pipeline.run(spark, sf_dir).collect()) == Counter(ids(after))


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages_take_awkward_rows(spark):
    docs = awkward(spark)
    for name, stage in corpus_pipeline.STAGES:
        for own in (docs, docs.limit(0)):
            result = stage(spark, own, SMALL)
            assert name == "mixing" or result.columns == own.columns
            assert result.count() <= own.count()
