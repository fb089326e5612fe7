"""One switch for both marts: readers see all of a publication or nothing of it."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from gridplume.operators import quality
from gridplume.plans import flows, models, published
from gridplume.session import glob_paths
from gridplume.sources import lake
from gridplume.sources.ledger import read_ledger
from gridplume.streaming import snapshots
from tests.rows import RUN_TS, as_set, daily_row, raw, reading
from tests.test_runs import STATES, AS_OF, land, places, stored, text_file  # noqa: F401


def load(spark, places, *rows):  # noqa: F811
    lake.load_truncate(raw(spark, *rows), places.raw)


def seen(spark, places):  # noqa: F811
    """What a reader of the library, and one of the views, sees of both marts."""
    by_library = {n: {(str(r.date), r.total_gross_load_mw) for r in df.collect()} for n, df in flows.read_marts(spark, places).items()}
    by_view = {n: {(str(r.date), r.total_gross_load_mw) for r in spark.table(places.mart(n)).collect()} for n in by_library}
    assert by_library == by_view
    assert by_library["mart_emissions_over_time"] == by_library["mart_emissions_by_fuel"], "one publication for both"
    return by_library["mart_emissions_over_time"]


FEB = daily_row(date=date(2024, 2, 1), month=2)


def test_a_reader_between_the_writes_sees_the_old_marts(spark, places, monkeypatch):  # noqa: F811
    load(spark, places, daily_row(), FEB)
    flows.refresh_models(spark, places)
    old = {("2024-01-01", 10.0), ("2024-02-01", 10.0)}
    assert seen(spark, places) == old
    looks = []
    stage, switch = models.stage_mart, published.switch

    def look(real):
        def step(*args, **options):
            looks.append(seen(spark, places))
            result = real(*args, **options)
            looks.append(seen(spark, places))
            return result

        return step

    monkeypatch.setattr(models, "stage_mart", look(stage))
    monkeypatch.setattr(published, "switch", look(switch))
    load(spark, places, daily_row(gross_load_mw=5.0), {**FEB, "gross_load_mw": 6.0})
    flows.refresh_models(spark, places, spark.createDataFrame([(2024, 1), (2024, 2)], "year int, month int"))
    new = {("2024-01-01", 5.0), ("2024-02-01", 6.0)}
    assert looks == [old] * 5 + [new]


@pytest.mark.parametrize("at", ["second mart", "manifest", "rename"])
def test_a_publication_that_stops_is_not_seen_and_the_next_one_is_whole(spark, places, monkeypatch, at):  # noqa: F811
    load(spark, places, daily_row(), FEB)
    flows.refresh_models(spark, places)
    old = seen(spark, places)
    load(spark, places, daily_row(gross_load_mw=5.0), {**FEB, "gross_load_mw": 6.0})

    class Stopped(Exception):
        pass

    def stop(*args, **options):
        raise Stopped

    with monkeypatch.context() as m:
        stage = models.stage_mart
        if at == "second mart":
            m.setattr(models, "stage_mart", lambda df, path: stop() if "by_fuel" in path else stage(df, path))
        elif at == "manifest":
            m.setattr(published, "switch", stop)
        else:
            m.setattr(published, "rename_path", stop)
        with pytest.raises(Stopped):
            flows.refresh_models(spark, places)
    assert seen(spark, places) == old
    flows.refresh_models(spark, places, spark.createDataFrame([(2024, 1)], "year int, month int"))
    assert seen(spark, places) == {("2024-01-01", 5.0), ("2024-02-01", 10.0)}
    root = places.published(spark)
    published.drop_unused(spark, root)
    assert seen(spark, places) == {("2024-01-01", 5.0), ("2024-02-01", 10.0)}
    assert len(glob_paths(spark, f"{root}/*/version=*/year=*/month=*")) == 4
    assert len(glob_paths(spark, f"{root}/manifest/*")) == 1 and not glob_paths(spark, f"{root}/manifest/.staged-*")


def test_months_of_another_publication_in_between_are_kept(spark, places, monkeypatch):  # noqa: F811
    root = places.published(spark)
    rename = published.rename_path
    between = []

    def late(spark, path, to):
        if not between:
            between.append(to)
            published.switch(spark, root, "vB", {"m": [(2024, 2)]}, [(2024, 2)], ("s", 3))
        return rename(spark, path, to)

    published.switch(spark, root, "v0", {"m": [(2024, 1), (2024, 2)]})
    monkeypatch.setattr(published, "rename_path", late)
    now = published.switch(spark, root, "vA", {"m": [(2024, 1)]}, [(2024, 1)], ("t", 1))
    assert now.versions == {("m", 2024, 1): "vA", ("m", 2024, 2): "vB"} and now.batches == {"s": 3, "t": 1} and now.number == 3


def test_a_month_without_rows_vanishes_and_marts_may_be_empty(spark, places):  # noqa: F811
    load(spark, places, daily_row(date=None))
    flows.refresh_models(spark, places)
    assert seen(spark, places) == set()
    load(spark, places, daily_row(), FEB)
    flows.refresh_models(spark, places)
    assert len(seen(spark, places)) == 2
    lake.load_replace(raw(spark, daily_row(date=None, month=2)), places.raw)
    flows.refresh_models(spark, places, spark.createDataFrame([(2024, 2)], "year int, month int"))
    assert seen(spark, places) == {("2024-01-01", 10.0)}


def test_views_prune_other_versions(spark, places):  # noqa: F811
    from tests.rows import plan

    load(spark, places, daily_row(), FEB)
    for _ in range(3):
        flows.refresh_models(spark, places)
    text = plan(spark.table(places.mart("mart_emissions_over_time")))
    assert "dynamicpruning" in text
    assert len(flows.read_marts(spark, places)["mart_emissions_over_time"].inputFiles()) == 2


def test_streamed_snapshots_refresh_the_marts(spark, places, path):  # noqa: F811
    checkpoint = path("checkpoint")
    rounds = [
        (1, [reading(), reading(stateCode="AK"), reading(date="2024-02-01")], {("2024-01-01", 10.0), ("2024-02-01", 10.0)}),
        (2, [reading(date="2024-02-01", grossLoad="11")], {("2024-01-01", 10.0), ("2024-02-01", 11.0)}),
    ]
    for snapshot, readings, want in rounds:
        land(spark, places, *readings, snapshot=snapshot)
        snapshots.snapshot_stream(spark, places, checkpoint, RUN_TS, models=True).awaitTermination()
        assert seen(spark, places) == want
    now = published.newest(spark, places.published(spark))
    assert list(now.batches.values()) == [1] and now.number == 2
    # January was not touched by the second batch: its folders are still those of the first.
    versions = {(mart, m): v for (mart, y, m), v in now.versions.items()}
    assert versions["mart_emissions_by_fuel", 1] != versions["mart_emissions_by_fuel", 2]


def test_a_repeated_batch_changes_nothing(spark, places, path):  # noqa: F811
    land(spark, places, reading(), snapshot=1)
    touched = spark.createDataFrame([("TX", 2024, 1)], "state string, year int, month int")
    for k in (0, 1):
        snapshots.apply_batch(spark, places, touched, RUN_TS + timedelta(days=k), ("stream", k))
    root = places.published(spark)
    before = published.newest(spark, root), as_set(read_ledger(spark, places.ledger)), lake.raw_table(spark, places.raw).inputFiles(), seen(spark, places)
    # Even if more has landed meanwhile: that is a batch of its own.
    land(spark, places, reading(grossLoad="99"), snapshot=2)
    for k in (0, 1):
        snapshots.apply_batch(spark, places, touched, RUN_TS + timedelta(days=5), ("stream", k))
    after = published.newest(spark, root), as_set(read_ledger(spark, places.ledger)), lake.raw_table(spark, places.raw).inputFiles(), seen(spark, places)
    assert after == before
    snapshots.apply_batch(spark, places, touched, RUN_TS + timedelta(days=6), ("stream", 2))
    assert seen(spark, places) == {("2024-01-01", 99.0)}


def test_a_batch_that_fails_its_data_tests_is_not_published_and_comes_again(spark, places, path):  # noqa: F811
    touched = spark.createDataFrame([("TX", 2024, 1)], "state string, year int, month int")
    land(spark, places, reading(), snapshot=1)
    snapshots.apply_batch(spark, places, touched, RUN_TS, ("stream", 0))
    land(spark, places, reading(), reading(facilityId="none"), snapshot=2)
    with pytest.raises(quality.QualityError):
        snapshots.apply_batch(spark, places, touched, RUN_TS, ("stream", 1))
    assert seen(spark, places) == {("2024-01-01", 10.0)}
    land(spark, places, reading(grossLoad="3"), snapshot=3)
    snapshots.apply_batch(spark, places, touched, RUN_TS, ("stream", 1))
    assert seen(spark, places) == {("2024-01-01", 3.0)}


def test_a_batch_without_a_good_chunk_is_noted(spark, places):  # noqa: F811
    touched = spark.createDataFrame([("TX", 2024, 1)], "state string, year int, month int")
    text_file(places.landing, "state=TX/year=2024/month=1/snapshot=1", "{cut")
    for _ in range(2):
        snapshots.apply_batch(spark, places, touched, RUN_TS, ("stream", 4))
    assert published.newest(spark, places.published(spark)).batches == {"stream": 4}
    assert read_ledger(spark, places.ledger).count() == 1


def test_events_of_files_read_no_content(spark, places, path, setting):  # noqa: F811
    # A file that is longer than this can't be read as a whole; its event can.
    setting("spark.sql.sources.binaryFile.maxLength", "1")
    land(spark, places, reading(), reading(date="2024-02-01"), snapshot=1)
    events = snapshots.touched_chunks(spark.readStream, places.landing)
    out, checkpoint = path("events"), path("checkpoint")
    events.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    assert as_set(spark.read.parquet(out).distinct()) == [("TX", 2024, 1), ("TX", 2024, 2)]


def test_exact_facilities_come_from_the_intermediate_rows(spark, places):  # noqa: F811
    from pyspark.sql import functions as F

    from tests.rows import plan

    ids = [1, 1, 2, 32768, 32769, 70000, -5, 0, 2**62, None]
    rows = [daily_row(facility_id=i, unit_id=f"U{k}", primary_fuel=["Coal", "Wind"][k % 2], date=date(2024, 1, 1 + k % 3)) for k, i in enumerate(ids)]
    load(spark, places, *rows, daily_row(state="AK", facility_id=None, unit_id="x"))
    models_rows = models.stg_cems_daily(lake.raw_table(spark, places.raw))
    flows.store_intermediate(lake.raw_table(spark, places.raw), places.intermediate)
    ranges = flows.intermediate(spark, places)
    want = {r.state: r.n for r in models_rows.groupBy("state").agg(F.count_distinct("facility_id").alias("n")).collect()}
    by_state = models.exact_facilities(ranges, ["state"])
    assert {r.state: r.facility_count_exact for r in by_state.collect()} == want == {"TX": 8, "AK": 0}
    daily = models.exact_facilities(ranges, ["date", "state"])
    assert as_set(daily) == as_set(models.facility_count_exact(models_rows))
    assert places.raw not in plan(daily)
    # Ranges add up to the model.
    sums = [F.sum(c).alias(c) for c in models.INT_SUMS]
    added = ranges.groupBy(*models.INT_KEYS).agg(*sums)
    assert as_set(added) == as_set(models.int_cems_aggregated(models_rows).select(*added.columns))


def test_intermediate_rows_are_bounded_by_their_number_and_bitmaps_do_not_move(spark, places, monkeypatch):  # noqa: F811
    from tests.rows import plan

    monkeypatch.setattr(flows, "_RANGE_ROWS", 20)
    changes = [
        {"facility_id": f if f % 7 else None, "unit_id": f"U{u}" if u else None, "date": date(2024, m, 1 + f % 20), "month": m, "gross_load_mw": None if u else 1.5}
        for m in (1, 2) for f in [*range(40), 40_000, -3] for u in (0, 1)
    ]
    rows = raw(spark, *[daily_row(**c) for c in changes], daily_row(date=None, month=2))
    flows.store_intermediate(rows, places.intermediate)
    stored = flows.intermediate(spark, places)
    per_file = stored.groupBy(F.input_file_name()).count().collect()
    assert len(per_file) >= stored.count() // 20 > 1 and max(f["count"] for f in per_file) <= 40
    want = {}
    for c in changes:
        f = c["facility_id"]
        key = (c["date"], None if f is None else 1 + (f - 1) // 32_768 if f > 0 else 0)
        group = want.setdefault(key, [set(), 0.0, 0, 0])
        group[0] |= {c["facility_id"]} - {None}
        group[1] += c["gross_load_mw"] or 0.0
        group[2] += c["facility_id"] is None
        group[3] += c["unit_id"] is None
    found = stored.groupBy("date", "facility_range").agg(
        *[F.sum(c) for c in ("facility_count", "total_gross_load_mw", "failures_2", "failures_3")], F.count(F.lit(1))
    )
    assert {(r[0], r[1]): tuple(r[2:]) for r in found.collect()} == {k: (len(g[0]), *g[1:], 1) for k, g in want.items()}
    text = plan(models.int_by_facility_range(models.stg_cems_daily(rows)), "simple")
    made = [i for i, line in enumerate(text.splitlines()) if "bitmap_construct_agg" in line]
    moved = [i for i, line in enumerate(text.splitlines()) if "Exchange" in line]
    assert made and min(moved) > max(made), "bitmaps are made above all shuffles"
