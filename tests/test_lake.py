from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from gridplume.operators.joins import semi_join
from gridplume.operators.snapshots import latest_snapshot
from gridplume.plans import models
from gridplume.session import as_written
from gridplume.sources import lake
from tests.rows import RUN_TS, as_set, daily_row, many_rows, plan, raw

JAN = daily_row()
FEB = daily_row(date=date(2024, 2, 1), month=2)
AK = daily_row(state="AK")


def test_folders_are_padded_and_rows_come_back(spark, path):
    root = path("lake")
    rows = raw(spark, JAN, FEB, AK)
    lake.lake_write(rows, root)
    assert any("/state=TX/year=2024/month=01/" in f for f in lake.raw_scan_all(spark, root).inputFiles())
    assert as_set(lake.raw_scan_all(spark, root).select(*rows.columns)) == as_set(rows)


def test_write_replaces_its_chunks_and_keeps_others(spark, path):
    root = path("lake")
    lake.lake_write(raw(spark, JAN, {**JAN, "unit_id": "U2"}, FEB, AK), root)
    lake.lake_write(raw(spark, {**JAN, "unit_id": "U3"}), root)
    found = {(r.state, r.month, r.unit_id) for r in lake.raw_scan_all(spark, root).collect()}
    assert found == {("TX", 1, "U3"), ("TX", 2, "U1"), ("AK", 1, "U1")}


def test_a_large_chunk_is_written_by_many_tasks(spark, path, setting):
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    root, table = path("lake"), path("raw")
    lake.lake_write(many_rows(spark, 200_000), root)
    assert len(lake.raw_scan_all(spark, root).inputFiles()) > 4
    lake.load_truncate(lake.raw_scan_all(spark, root), table)
    assert len(lake.raw_table(spark, table).inputFiles()) > 4
    assert lake.load_row_count(spark, table).first()[0] == 200_000


def test_a_small_chunk_is_one_file(spark, path):
    root = path("lake")
    lake.lake_write(many_rows(spark, 2000), root)
    assert len(lake.raw_scan_all(spark, root).inputFiles()) == 1


def test_scans_of_months_and_paths(spark, path):
    root = path("lake")
    lake.lake_write(raw(spark, JAN, FEB, AK), root)
    assert lake.raw_scan_months(spark, root, [(2024, 1)]).count() == 2
    assert lake.raw_scan_months(spark, root, [(2024, 1), (2024, 2)]).count() == 3
    assert lake.raw_scan_months(spark, root, [(2030, 1)]).isEmpty()
    assert lake.raw_scan_months(spark, root, []).isEmpty()
    one = lake.raw_scan_paths(spark, root, f"{root}/state=AK")
    assert [(r.state, r.year, r.month) for r in one.collect()] == [("AK", 2024, 1)]
    two = [f"{root}/state=TX/year=2024/month=01", f"{root}/state=TX/year=2024/month=02"]
    assert {(r.state, r.month) for r in lake.raw_scan_paths(spark, root, two).collect()} == {("TX", 1), ("TX", 2)}


def test_month_scan_prunes_folders(spark, path):
    root = path("lake")
    lake.lake_write(raw(spark, JAN, FEB, AK), root)
    listed = plan(lake.raw_scan_months(spark, root, [(2024, 1)]))
    assert "(year#" in listed.split("PartitionFilters")[1].split("\n")[0]
    months = spark.createDataFrame([(2024, 1)], "year int, month int")
    joined = lake.raw_scan_months(spark, root, months)
    assert "dynamicpruning" in plan(joined)
    assert joined.count() == 2


def test_date_range_prunes_folders(spark, path):
    table = path("raw")
    lake.load_truncate(raw(spark, JAN, FEB, {**JAN, "date": date(2023, 12, 31), "year": 2023, "month": 12}), table)
    ranged = lake.in_range(lake.raw_table(spark, table), date(2024, 1, 1), date(2024, 2, 1))
    assert ranged.count() == 2
    text = plan(ranged)
    assert "202401" in text.split("PartitionFilters")[1].split("\n")[0]
    assert "GreaterThanOrEqual(date,2024-01-01)" in text
    # The predicate also passes through the models down to the scan.
    over_time = models.source_ref("mart_emissions_over_time", {"raw_cems_daily": ranged})
    assert "202401" in plan(over_time).split("PartitionFilters")[1].split("\n")[0]


def tables(spark, path):
    root, table = path("lake"), path("raw")
    lake.lake_write(raw(spark, JAN, FEB, AK), root)
    lake.load_truncate(lake.raw_scan_all(spark, root), table)
    return root, table


def totals(spark, table):
    mart = models.source_ref("mart_emissions_over_time", {"raw_cems_daily": lake.raw_table(spark, table)})
    return {(r.date, r.state): (r.total_gross_load_mw, r.facility_count) for r in mart.collect()}


def test_append_doubles_sums_and_replace_does_not(spark, path):
    root, table = tables(spark, path)
    before = totals(spark, table)
    assert lake.load_replace(lake.raw_scan_months(spark, root, [(2024, 1)]), table) == 2, "rows written"
    assert totals(spark, table) == before
    lake.load_append(lake.raw_scan_months(spark, root, [(2024, 1)]), table)
    after = totals(spark, table)
    for key, (load, count) in before.items():
        assert after[key] == ((2 * load, count) if key[0].month == 1 else (load, count))
    lake.load_truncate(lake.raw_scan_all(spark, root), table)
    assert totals(spark, table) == before


def test_loading_a_month_without_files_changes_nothing(spark, path):
    root, table = tables(spark, path)
    before = totals(spark, table)
    for load in (lake.load_append, lake.load_replace):
        assert load(lake.raw_scan_months(spark, root, [(2031, 5)]), table) == 0
    assert totals(spark, table) == before


def test_files_are_sorted_for_skipping(spark, path):
    table = path("raw")
    states = many_rows(spark, 3000).withColumn("state", F.substring(F.md5("facility_name"), 1, 1))
    lake.load_truncate(states, table)
    stored = [tuple(r) for r in lake.raw_table(spark, table).select("state", "facility_id", "date").collect()]
    assert stored == sorted(stored)


def versions(spark):
    old, new = RUN_TS, RUN_TS + timedelta(days=1)
    return raw(
        spark, JAN, {**JAN, "unit_id": "U2"}, {**JAN, "ingested_at": new, "gross_load_mw": 11.0}, FEB, AK,
        {**AK, "state": None}, {**AK, "state": None, "ingested_at": new}, {**FEB, "year": None, "month": None},
        {**JAN, "state": "HI", "ingested_at": None},
    )


THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_latest_snapshot_is_per_chunk(spark, setting, threshold):
    setting(THRESHOLD, threshold)
    rows = versions(spark)
    newest = latest_snapshot(rows)
    found = sorted((r.state or "", r.month or 0, r.unit_id, r.gross_load_mw) for r in newest.collect())
    assert found == [
        ("", 1, "U1", 10.0), ("AK", 1, "U1", 10.0), ("HI", 1, "U1", 10.0), ("TX", 0, "U1", 10.0),
        ("TX", 1, "U1", 11.0), ("TX", 2, "U1", 10.0),
    ]
    assert newest.columns == rows.columns


@pytest.mark.parametrize("threshold", ["10m", "-1"])
@pytest.mark.parametrize("anti", [False, True])
def test_a_side_of_key_columns_alone(spark, setting, threshold, anti):
    setting(THRESHOLD, threshold)
    keys = ["state", "year", "month"]
    big = raw(spark, JAN, FEB, AK, {**AK, "year": None}).select(*keys)
    small = raw(spark, JAN, AK).select(*keys)
    want = [(0, "AK"), (2, "TX")] if anti else [(1, "AK"), (1, "TX")]
    found = semi_join(big, small, keys, anti).collect()
    assert sorted((r.month if r.year else 0, r.state) for r in found) == want
    assert semi_join(big, small.limit(0), keys, anti).count() == (4 if anti else 0)


def test_latest_snapshot_does_not_move_the_rows(spark):
    newest = latest_snapshot(as_written(many_rows(spark, 100), "rows"))
    text = plan(newest, "simple")
    assert "BroadcastHashJoin" in text and "Window" not in text and "hashpartitioning" not in text


def test_beyond_the_broadcast_bound_a_hot_group_of_equal_rows_is_split(spark, setting):
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "4k")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    setting(THRESHOLD, "-1")
    equal = many_rows(spark, 50_000).withColumns({"facility_id": F.lit(1), "gross_load_mw": F.lit(1.0), "facility_name": F.lit("P")})
    rows = as_written(equal.unionByName(raw(spark, FEB, AK)), "rows")
    keys = rows.select("state", "year", "month").distinct()
    kept = semi_join(rows, keys, ["state", "year", "month"])
    assert "Broadcast" not in plan(kept, "simple")
    assert kept.count() == 50_002
    hot = kept.where("state = 'TX' and month = 1").select(F.spark_partition_id().alias("p")).distinct().count()
    assert hot > 1, "one chunk, many tasks"


def test_files_of_a_month_hold_few_states_and_a_large_state_is_split(spark, path, setting):
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    table = path("raw")
    states = F.when(F.col("facility_id") % 3 == 0, "S00").otherwise(F.format_string("S%02d", F.col("facility_id") % 50))
    rows = many_rows(spark, 60_000).withColumn("state", states)
    lake.load_truncate(rows, table)
    stored = lake.raw_table(spark, table)
    by_file = stored.select("state", F.input_file_name().alias("f")).groupBy("f").agg(F.count_distinct("state").alias("states"), F.count(F.lit(1)).alias("n"))
    files = by_file.collect()
    assert stored.count() == 60_000 and len(files) > 30
    assert sum(f["states"] for f in files) <= len(files) + 50, "ranges of states overlap at their ends only"
    assert stored.where("state = 'S00'").select(F.input_file_name()).distinct().count() > 5


def test_rows_without_a_state_stay_in_their_chunk(spark, path):
    root = path("lake")
    nameless = {**JAN, "state": None}
    owned = raw(spark, nameless, JAN).withColumn("chunk_state", F.lit("TX"))
    other = raw(spark, {**nameless, "unit_id": "U9"}).withColumn("chunk_state", F.lit("AK"))
    lake.lake_write(owned, root)
    lake.lake_write(other, root)
    found = sorted((r.state or "", r.unit_id) for r in lake.raw_scan_all(spark, root).collect())
    assert found == [("", "U1"), ("", "U9"), ("TX", "U1")]
    assert lake.raw_scan_paths(spark, root, f"{root}/state=TX").count() == 2


@pytest.mark.parametrize("sized", [True, False])
def test_rows_that_store_in_few_bytes_are_split_by_their_number(spark, path, monkeypatch, sized):
    monkeypatch.setattr(lake, "FILE_ROWS", 1000)
    root, table = path("lake"), path("raw")
    alike = many_rows(spark, 10_000).withColumns({"facility_name": F.lit("P"), "gross_load_mw": F.lit(1.0)})
    states = F.when(F.col("facility_id") % 2 == 0, "TX").otherwise(F.format_string("S%02d", F.col("facility_id") % 11))
    rows = alike.withColumn("state", states)
    lake.lake_write(rows, root)
    sizes = lake.stored_bytes(spark, root, [(2024, 1)])
    counted = {(r.state, r.rows) for r in sizes.collect()}
    assert counted == {tuple(r) for r in rows.groupBy("state").count().collect()}
    assert sizes.agg(F.sum("bytes")).first()[0] < 256 << 10, "one file, by its bytes"
    assert lake.load_replace(lake.raw_scan_all(spark, root), table, sizes if sized else None) == 10_000
    files = lake.raw_table(spark, table).groupBy(F.input_file_name()).count().collect()
    assert 10 <= len(files) <= 12 and max(f["count"] for f in files) < 1500
    assert as_set(lake.raw_table(spark, table).select(*rows.columns)) == as_set(rows)
