from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gridplume.llm import exact_dedup as ex
from gridplume.llm.common import located, table
from tests.llm.rows import awkward, none


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    """(id, text) -> how often each (id, keep_id, group_size) must occur; and the number of rows that stay."""
    groups = defaultdict(list)
    for i, text in rows:
        groups[fold(text)].append(i)
    low = -1 << 62
    return sorted((low if i is None else i, max((x for x in own if x is not None), default=low), len(own)) for own in groups.values() for i in own), len(groups)


def found(df):
    low = -1 << 62
    rows = df.collect()
    return sorted((low if r["id"] is None else r["id"], low if r["keep_id"] is None else r["keep_id"], r["group_size"]) for r in rows), sum(r["kept"] for r in rows)


@pytest.mark.parametrize("bits", [256, 4])
def test_classes_equal_brute_force_also_when_digests_collide(spark, bits):
    docs = awkward(spark)
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert found(ex.classes(docs, bits=bits)) == want


@pytest.mark.parametrize("bits", [8])
def test_collisions_on_the_tables(spark, bits):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    assert found(ex.classes(docs, bits=bits)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_empty_table(spark):
    assert ex.classes(none(spark)).count() == 0


def test_state_lives_on_between_runs(spark, path):
    docs = spark.createDataFrame([(1, "one"), (2, "two"), (3, "ONE")], "doc_id long, text string")
    more = spark.createDataFrame([(9, "Two"), (4, "one"), (5, "three")], "doc_id long, text string")
    folder, checkpoint = path("landing"), path("checkpoint")
    states = []
    for part in (docs, more, more.limit(0)):
        part, place = located(part)
        landing = ex.land(part, place, "doc_id", "text", folder)
        states.append({(r["last"]["id"], r["copies"]) for r in ex.take_in(spark, landing, folder, checkpoint, files_per_batch=2).collect()})
    assert states == [{(3, 2), (2, 1)}, {(4, 3), (9, 2), (5, 1)}, {(4, 3), (9, 2), (5, 1)}]


def test_copies_of_one_text_move_as_one_row_per_task(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("text"))
    rows = ex.classes(docs)
    hot = rows.where("group_size > 1").groupBy("keep_id", "group_size").count().collect()
    assert [tuple(r) for r in hot] == [(19_998, 6667, 6667)]
    assert rows.where("kept").count() == 13_334
