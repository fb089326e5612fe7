from dataclasses import replace
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from gridplume import fixtures as fx
from gridplume.operators import quality
from gridplume.operators.shaping import daily_rows
from gridplume.plans import flows
from gridplume.session import path_exists
from gridplume.sources import lake
from gridplume.sources.ledger import read_ledger
from gridplume.streaming.daily import compact_updates, daily_state, daily_stream
from gridplume.streaming.snapshots import snapshot_stream
from gridplume.schemas import DAILY_KEYS, MEASURES
from tests.rows import RUN_TS, as_set, hourly, reading
from tests.test_landing import BROKEN, land_array, text_file

AS_OF = date(2024, 4, 10)  # look-back: January to March 2024
STATES = ["AK", "TX"]


@pytest.fixture
def places(path, request):
    return flows.Places.below(path("run"), f"run_{request.node.name.split('[')[0][:40]}")


def land(spark, places, *readings, snapshot=None):
    rows = fx.with_folders(hourly(spark, *readings))
    fx.land(rows if snapshot is None else rows.withColumn("snapshot", F.lit(snapshot)), places.landing)


def stored(spark, places):
    return sorted((r.state, str(r.date), r.unit_id, r.gross_load_mw) for r in lake.raw_scan_all(spark, places.lake).collect())


def statuses(spark, places, stamp):
    rows = read_ledger(spark, places.ledger).where(F.col("run_ts") == F.lit(stamp)).collect()
    return {r.chunk_key: (r.status, r.rows) for r in rows}


def test_backfill_and_its_retry(spark, places):
    land(spark, places, reading(), reading(), reading(stateCode="AK"), snapshot=1)
    land(spark, places, reading(date="2024-02-03"), reading(date="2024-02-04", unitId="U2"), snapshot=1)
    land_array(places.landing, "state=AK/year=2024/month=2/snapshot=1", [], lines=True)
    bad = [reading(date="2024-03-01"), reading(date="oops")]
    land_array(places.landing, "state=TX/year=2024/month=3/snapshot=1", bad, lines=True)
    first = flows.backfill(spark, places, AS_OF, RUN_TS, date(2024, 1, 1), STATES).first().asDict()
    assert first == {"total": 6, "already_done": 0, "remaining": 6, "succeeded": 3, "empty": 1, "failed": 2, "rows": 4}
    assert statuses(spark, places, RUN_TS) == {
        "TX-2024-01": ("ok", 1), "AK-2024-01": ("ok", 1), "TX-2024-02": ("ok", 2), "AK-2024-02": ("empty", 0),
        "TX-2024-03": ("failed", 0), "AK-2024-03": ("failed", 0),
    }
    assert stored(spark, places) == [
        ("AK", "2024-01-01", "U1", 10.0), ("TX", "2024-01-01", "U1", 20.0),
        ("TX", "2024-02-03", "U1", 10.0), ("TX", "2024-02-04", "U2", 10.0),
    ]
    # A corrected file lands as a newer snapshot; the finished chunks are not read again.
    land_array(places.landing, "state=TX/year=2024/month=3/snapshot=2", [reading(date="2024-03-01")], lines=True)
    later = RUN_TS + timedelta(days=1)
    second = flows.backfill(spark, places, AS_OF, later, date(2024, 1, 1), STATES).first().asDict()
    assert second == {"total": 6, "already_done": 4, "remaining": 2, "succeeded": 1, "empty": 0, "failed": 1, "rows": 1}
    assert statuses(spark, places, later) == {"TX-2024-03": ("ok", 1), "AK-2024-03": ("failed", 0)}
    assert len(stored(spark, places)) == 5
    assert flows.load_all(spark, places).first()[0] == 5


def mart(spark, places, name="mart_emissions_over_time"):
    return {(str(r.date), r.state): r.total_gross_load_mw for r in spark.table(places.mart(name)).collect()}


def test_daily_run_replaces_what_was_resubmitted(spark, places):
    land(spark, places, reading(), reading(unitId="U2"), reading(stateCode="AK"), reading(date="2023-06-01"), snapshot=1)
    land(spark, places, reading(date="2024-02-01"), snapshot=1)
    assert flows.daily_run(spark, places, AS_OF, RUN_TS, STATES)
    before = {("2024-01-01", "TX"): 20.0, ("2024-01-01", "AK"): 10.0, ("2024-02-01", "TX"): 10.0}
    assert mart(spark, places) == before
    # Again without news: nothing adds up twice.
    assert flows.daily_run(spark, places, AS_OF, RUN_TS + timedelta(days=1), STATES)
    assert mart(spark, places) == before
    # A re-submitted month lacks a unit: it vanishes. The other state keeps its rows.
    land(spark, places, reading(grossLoad="11"), snapshot=2)
    assert flows.daily_run(spark, places, AS_OF, RUN_TS + timedelta(days=2), STATES)
    assert mart(spark, places) == {**before, ("2024-01-01", "TX"): 11.0}
    by_fuel = spark.table(places.mart("mart_emissions_by_fuel"))
    assert by_fuel.count() == 3 and by_fuel.columns[:3] == ["date", "state", "fuel_category"]


def test_months_outside_the_window_keep_their_marts(spark, places):
    land(spark, places, reading(), reading(date="2023-06-01"))
    flows.backfill(spark, places, AS_OF, RUN_TS, date(2023, 1, 1), STATES)
    flows.load_all(spark, places)
    flows.refresh_models(spark, places)
    assert flows.daily_run(spark, places, AS_OF, RUN_TS, STATES)
    assert mart(spark, places) == {("2024-01-01", "TX"): 10.0, ("2023-06-01", "TX"): 10.0}
    full = as_set(spark.table(places.mart("mart_emissions_by_fuel")))
    flows.refresh_models(spark, places)
    assert as_set(spark.table(places.mart("mart_emissions_by_fuel"))) == full


def test_a_chunk_that_lacks_a_field_is_bad_and_one_with_nulls_is_not(spark, places):
    short = {k: v for k, v in reading().items() if k != "stateCode"}
    nulls = [reading(stateCode="AK", unitType=None), reading(stateCode="AK", unitType=None, co2Mass=None)]
    land_array(places.landing, "state=TX/year=2024/month=1/snapshot=1", [short], lines=True)
    land_array(places.landing, "state=AK/year=2024/month=1/snapshot=1", nulls, lines=True)
    assert flows.backfill(spark, places, date(2024, 2, 10), RUN_TS, date(2024, 1, 1), STATES).first().failed == 1
    assert statuses(spark, places, RUN_TS) == {"AK-2024-01": ("ok", 1), "TX-2024-01": ("failed", 0)}
    with pytest.raises(flows.BadChunks, match="state=TX"):
        flows.daily_run(spark, places, AS_OF, RUN_TS, STATES)
    land_array(places.landing, "state=TX/year=2024/month=1/snapshot=2", [reading()], lines=True)
    loaded = flows.daily_run(spark, places, AS_OF, RUN_TS, STATES)
    assert [(c.chunk_path, c.rows) for c in loaded] == [
        ("state=AK/year=2024/month=01", 1), ("state=TX/year=2024/month=01", 1),
    ]


def test_nothing_landed_skips_load_and_models(spark, places):
    assert not flows.daily_run(spark, places, AS_OF, RUN_TS, STATES)
    land(spark, places, reading(date="2020-01-01"))
    assert not flows.daily_run(spark, places, AS_OF, RUN_TS, STATES)
    assert not spark.catalog.tableExists(places.mart("mart_emissions_over_time"))


def test_bad_date_stops_a_daily_run_before_it_writes(spark, places):
    land(spark, places, reading(stateCode="AK"))
    land_array(places.landing, "state=TX/year=2024/month=1", [reading(date="oops")], lines=True)
    with pytest.raises(flows.BadChunks, match="state=TX/year=2024/month=01"):
        flows.daily_run(spark, places, AS_OF, RUN_TS, STATES)
    assert not path_exists(spark, places.lake)


@pytest.mark.parametrize("publish_first", [False, True])
def test_failing_test_stops_the_run(spark, places, publish_first):
    land(spark, places, reading(), snapshot=1)
    flows.daily_run(spark, places, AS_OF, RUN_TS, STATES)
    land(spark, places, reading(), reading(facilityId="none"), snapshot=2)
    with pytest.raises(quality.QualityError, match="stg_cems_daily.facility_id not_null: 1 rows"):
        flows.daily_run(spark, places, AS_OF, RUN_TS + timedelta(days=1), STATES, publish_first)
    assert mart(spark, places) == {("2024-01-01", "TX"): 20.0 if publish_first else 10.0}


def test_streamed_days_equal_the_batch(spark, path):
    landing, updates, checkpoint = path("landing"), path("updates"), path("checkpoint")
    parts = [
        [reading(), reading(grossLoad=None), reading(facilityId="x"), reading(primaryFuelInfo=None)],
        [reading(), reading(date="2024-03-20"), reading(date="2024-03-20", grossLoad="NaN", unitId="U3")],
        [reading(grossLoad="5"), reading(date="2024-03-20")],  # January is 79 days late: accepted
    ]
    for part in parts:
        hourly(spark, *part).write.mode("append").json(landing)
        daily_stream(spark, landing, updates, checkpoint).awaitTermination()
    want = daily_rows(hourly(spark, *sum(parts, [])), RUN_TS).select(*DAILY_KEYS, *MEASURES)
    for _ in range(3):
        got = daily_state(spark, updates).withColumn("facility_id", F.col("facility_id").cast("bigint"))
        assert as_set(got) == as_set(want)
        compact_updates(spark, updates)
    assert not [f for f in daily_state(spark, updates).inputFiles() if "/batch=" in f]


def test_streamed_snapshots_equal_the_daily_load(spark, places, path):
    checkpoint = path("checkpoint")
    rounds = [
        (1, [reading(), reading(unitId="U2"), reading(stateCode="AK"), reading(date="2024-02-01")]),
        (2, [reading(grossLoad="11")]),
        (3, [reading(stateCode="AK", grossLoad="1"), reading(stateCode="AK", grossLoad="2")]),
    ]
    for snapshot, readings in rounds:
        land(spark, places, *readings, snapshot=snapshot)
        snapshot_stream(spark, places, checkpoint, RUN_TS).awaitTermination()
    table = lake.raw_table(spark, places.raw)
    got = sorted((r.state, str(r.date), r.unit_id, r.gross_load_mw) for r in table.collect())
    assert got == stored(spark, places) == [
        ("AK", "2024-01-01", "U1", 3.0), ("TX", "2024-01-01", "U1", 11.0), ("TX", "2024-02-01", "U1", 10.0),
    ]
    # A run without new files does nothing.
    snapshot_stream(spark, places, checkpoint, RUN_TS).awaitTermination()
    assert lake.raw_table(spark, places.raw).count() == 3


@pytest.mark.parametrize("fmt, broken", [(fmt, text) for fmt, texts in BROKEN.items() for text in texts[:3]])
def test_a_broken_fetch_fails_its_chunk_and_is_tried_again(spark, places, fmt, broken):
    places = replace(places, landing_format=fmt)
    lines = fmt == "json"
    text_file(places.landing, "state=TX/year=2024/month=1/snapshot=1", broken)
    land_array(places.landing, "state=AK/year=2024/month=1/snapshot=1", [reading(stateCode="AK")], lines=lines)
    as_of = date(2024, 2, 10)
    assert flows.backfill(spark, places, as_of, RUN_TS, date(2024, 1, 1), STATES).first().failed == 1
    assert statuses(spark, places, RUN_TS) == {"AK-2024-01": ("ok", 1), "TX-2024-01": ("failed", 0)}
    assert {r[0] for r in stored(spark, places)} == {"AK"}
    with pytest.raises(flows.BadChunks, match="state=TX"):
        flows.daily_run(spark, places, as_of, RUN_TS, STATES)
    land_array(places.landing, "state=TX/year=2024/month=1/snapshot=2", [reading()], lines=lines)
    assert flows.backfill(spark, places, as_of, RUN_TS + timedelta(days=1), date(2024, 1, 1), STATES).first().failed == 0
    assert {r[0] for r in stored(spark, places)} == {"AK", "TX"}


def test_a_parquet_fetch_without_a_field_fails(spark, places):
    places = replace(places, landing_format="parquet")
    folder = f"{places.landing}/state=TX/year=2024/month=1/snapshot="
    hourly(spark, reading()).drop("so2Mass").write.parquet(f"{folder}1")
    hourly(spark, reading(stateCode="AK", so2Mass=None)).write.parquet(folder.replace("TX", "AK") + "1")
    flows.backfill(spark, places, date(2024, 2, 10), RUN_TS, date(2024, 1, 1), STATES)
    assert statuses(spark, places, RUN_TS) == {"AK-2024-01": ("ok", 1), "TX-2024-01": ("failed", 0)}
    hourly(spark, reading()).write.parquet(f"{folder}2")
    flows.backfill(spark, places, date(2024, 2, 10), RUN_TS + timedelta(days=1), date(2024, 1, 1), STATES)
    assert len(stored(spark, places)) == 2


@pytest.mark.parametrize("odd", ["1e30", "inf", "-9223372036854775809000"])
def test_an_id_out_of_range_fails_its_chunk(spark, places, odd):
    land(spark, places, reading(facilityId=odd), snapshot=1)
    land(spark, places, reading(stateCode="AK"), snapshot=1)
    flows.backfill(spark, places, date(2024, 2, 10), RUN_TS, date(2024, 1, 1), STATES)
    assert statuses(spark, places, RUN_TS) == {"AK-2024-01": ("ok", 1), "TX-2024-01": ("failed", 0)}


def test_rows_without_a_state_belong_to_their_chunks(spark, places):
    for state, unit in (("TX", "U1"), ("AK", "U2")):
        land_array(places.landing, f"state={state}/year=2024/month=1/snapshot=1",
                   [reading(stateCode=None, unitId=unit), reading(stateCode=state)], lines=True)
        flows.backfill(spark, places, date(2024, 2, 10), RUN_TS, date(2024, 1, 1), [state])
    found = sorted((r.state or "", r.unit_id) for r in lake.raw_scan_all(spark, places.lake).collect())
    assert found == [("", "U1"), ("", "U2"), ("AK", "U1"), ("TX", "U1")]
    assert sum(r.rows for r in read_ledger(spark, places.ledger).collect()) == 4


def test_streamed_chunks_are_judged_one_by_one(spark, places, path):
    """A misplaced row destroys no other chunk, and a bad date holds up no good one."""
    checkpoint = path("checkpoint")
    land(spark, places, reading(stateCode="CA"), reading(stateCode="CA", unitId="U2"), snapshot=1)
    snapshot_stream(spark, places, checkpoint, RUN_TS).awaitTermination()
    land_array(places.landing, "state=TX/year=2024/month=1/snapshot=1", [reading(), reading(stateCode="CA", unitId="U9")], lines=True)
    land_array(places.landing, "state=WY/year=2024/month=1/snapshot=1", [reading(stateCode="WY", date="oops")], lines=True)
    land(spark, places, reading(stateCode="AK"), snapshot=1)
    later = RUN_TS + timedelta(days=1)
    snapshot_stream(spark, places, checkpoint, later).awaitTermination()
    assert [(r[0], r[2]) for r in stored(spark, places)] == [("AK", "U1"), ("CA", "U1"), ("CA", "U2")]
    assert statuses(spark, places, later) == {"AK-2024-01": ("ok", 1), "TX-2024-01": ("failed", 0), "WY-2024-01": ("failed", 0)}
    land_array(places.landing, "state=TX/year=2024/month=1/snapshot=2", [reading()], lines=True)
    snapshot_stream(spark, places, checkpoint, later + timedelta(days=1)).awaitTermination()
    assert [r[0] for r in stored(spark, places)] == ["AK", "CA", "CA", "TX"]
    assert lake.raw_table(spark, places.raw).count() == 4


def test_a_daily_run_lists_its_months_only(spark, places, monkeypatch):
    land(spark, places, reading(), snapshot=1)
    # Listed with the others, this folder would be taken for a month of its year and be read.
    text_file(places.landing, "state=TX/year=2016/month=01/snapshot=oops", "not json at all")
    listed = []
    real = flows.landed_files
    monkeypatch.setattr(flows, "landed_files", lambda spark, root, folders=None: (listed.append(folders), real(spark, root, folders))[1])
    assert len(flows.daily_run(spark, places, AS_OF, RUN_TS, STATES)) == 1
    assert len(listed) == 1 and listed[0] and all("/year=2024/" in f for f in listed[0])


def test_marts_change_by_month_and_their_date_filter_prunes(spark, places):
    from gridplume.plans import published, tiles
    from tests.rows import plan

    land(spark, places, reading(), reading(date="2024-02-01"), snapshot=1)
    flows.daily_run(spark, places, AS_OF, RUN_TS, STATES)
    name = "mart_emissions_over_time"
    table = flows.read_marts(spark, places)[name]
    tile = tiles.daily_generation(table, date(2024, 2, 1), date(2024, 2, 29))
    assert "202402" in plan(tile).split("PartitionFilters")[1].split("\n")[0] and tile.count() == 1
    january = [f for f in table.inputFiles() if "/month=1/" in f]
    months = spark.createDataFrame([(2024, 2)], "year int, month int")
    land(spark, places, reading(date="2024-02-01", grossLoad="33"), snapshot=2)
    flows.daily_run(spark, places, AS_OF, RUN_TS + timedelta(days=1), STATES)
    flows.refresh_models(spark, places, months)
    again = flows.read_marts(spark, places)[name]
    assert mart(spark, places) == {("2024-01-01", "TX"): 10.0, ("2024-02-01", "TX"): 33.0}
    assert [f for f in again.inputFiles() if "/month=2/" in f] and len(again.inputFiles()) == 2
    before = as_set(again)
    published.drop_unused(spark, places.published(spark))
    assert as_set(flows.read_marts(spark, places)[name]) == before and january
    assert as_set(spark.table(places.mart(name))) == before


def test_a_resumed_backfill_lists_only_what_is_left(spark, places, monkeypatch):
    for state in STATES:
        land(spark, places, reading(stateCode=state), reading(stateCode=state, date="2024-02-01"), snapshot=1)
    land(spark, places, reading(date="2024-03-01"), snapshot=1)
    first = flows.backfill(spark, places, AS_OF, RUN_TS, date(2024, 1, 1), STATES).first()
    assert (first.succeeded, first.failed) == (5, 1)
    # Listed with the others, this folder would be taken for a month of its year and be read.
    text_file(places.landing, "state=TX/year=2016/month=01/snapshot=oops", "not json at all")
    land(spark, places, reading(stateCode="AK", date="2024-03-01"), snapshot=1)
    listed = []
    real = flows.landed_files
    monkeypatch.setattr(flows, "landed_files", lambda spark, root, folders=None: (listed.append(folders), real(spark, root, folders))[1])
    later = RUN_TS + timedelta(days=1)
    assert flows.backfill(spark, places, AS_OF, later, date(2024, 1, 1), STATES).first().succeeded == 1
    assert [[f.split("/landing/")[1] for f in folders] for folders in listed] == [["state=AK/year=2024/month=3"]]


def test_raw_files_are_sized_by_the_bytes_of_the_lake(spark, path, setting):
    """Of the advisory size within a factor of two, for narrow and for wide rows, and without a pass over the rows."""
    from pyspark.sql import functions as F
    from tests.rows import many_rows

    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    for wide in (0, 300):
        root, table = path("lake"), path("raw")
        text = F.concat(*[F.md5(F.concat(F.lit(str(i)), F.col("facility_name"))) for i in range(1 + wide // 32)])
        rows = many_rows(spark, 30_000).withColumn("facility_name", text)
        lake.lake_write(rows.withColumn("state", F.when(F.col("facility_id") % 2 == 0, "TX").otherwise(F.format_string("S%02d", F.col("facility_id") % 11))), root)
        sizes = lake.stored_bytes(spark, root, [(2024, 1)])
        want = -(-sizes.agg(F.sum("bytes")).first()[0] // (256 << 10))
        assert lake.load_replace(lake.raw_scan_all(spark, root), table, sizes) == 30_000
        files = spark.read.format("binaryFile").load(table).select("length", "path").collect()
        assert want / 2 <= len(files) <= want + 1 and (want > 3 or not wide)
        assert max(f["length"] for f in files) < 2 * (256 << 10)
        states = lake.raw_table(spark, table).select("state", F.input_file_name().alias("f")).distinct().groupBy("f").count().agg(F.avg("count")).first()[0]
        assert not wide or states < 6, "a file of a month holds few of its 12 states"


def test_a_layout_by_bytes_takes_rows_without_a_state_and_unknown_months(spark, path):
    from tests.rows import daily_row, raw

    rows = raw(spark, daily_row(), daily_row(state=None), daily_row(state=None, month=2, date=date(2024, 2, 1)), daily_row(state="AK", year=2031, date=None))
    sizes = spark.createDataFrame([("TX", 2024, 1, 900_000_000), (None, 2024, 2, 5)], "state string, year int, month int, bytes bigint")
    for given in (sizes, sizes.limit(0)):
        assert as_set(lake.raw_layout(rows, given)) == as_set(rows)
    plan = {(r.state, r.month): (r.first, r.files) for r in lake.file_plan(sizes, 256 << 20).collect()}
    assert plan == {("TX", 1): (0, 4), (None, 1): (0, 4), (None, 2): (4, 1)}


def test_the_ledger_folds_and_tells_the_same(spark, path):
    from gridplume.operators import chunks as ch
    from gridplume.schemas import LEDGER
    from gridplume.sources import ledger

    place, stamps = path("ledger"), [RUN_TS + timedelta(days=k) for k in range(6)]
    calendar = ch.backfill_calendar(spark, AS_OF, date(2024, 1, 1), STATES)

    def told():
        return [ch.run_summary(calendar, read_ledger(spark, place), s).first() for s in stamps], as_set(read_ledger(spark, place))

    for k, stamp in enumerate(stamps[:5]):
        status = ["failed", "ok", "empty", "ok", "failed"][k]
        rows = [(f"TX-2024-0{1 + k % 3}", "TX", 2024, 1 + k % 3, status, k, stamp), ("AK-2024-01", "AK", 2024, 1, "failed", 0, stamp)]
        ledger.append_ledger(spark.createDataFrame(rows, LEDGER), place)
        if k in (1, 3):
            before = told()
            for _ in range(2):
                ledger.compact_ledger(spark, place)
                assert told() == before
            assert all("-base/upto=" in f for f in read_ledger(spark, place).inputFiles())
    assert read_ledger(spark, place).count() == 10 and told()[0][4].failed == 2
    ledger.fold_if_long(spark, place, entries=2)
    assert any("/entry=" in f for f in read_ledger(spark, place).inputFiles())
    ledger.fold_if_long(spark, place, entries=1)
    assert not any("/entry=" in f for f in read_ledger(spark, place).inputFiles())
