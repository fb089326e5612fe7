"""The routed stream: each reading is accepted, rejected or late, and none is lost."""

import json
import os

from pyspark.sql import functions as F

from gridplume.operators.shaping import daily_rows
from gridplume.schemas import DAILY_KEYS, MEASURES
from gridplume.streaming import routed
from tests.rows import RUN_TS, as_set, hourly, reading
from tests.test_landing import text_file


def state(spark, root, **options):
    return {(str(r.date), r.unit_id): r.gross_load_mw for r in routed.daily_rows(spark, root, **options).collect()}


def test_bad_and_late_readings_lie_aside(spark, path):
    landing, root, checkpoint = (path(n) for n in ("landing", "routed", "checkpoint"))
    rounds = [
        ([reading(), reading(date="oops", unitId="U2")], (1, 1, 0)),
        ([reading(date="2024-06-01"), reading()], (2, 0, 0)),
        ([reading(date="2024-06-01")], (1, 1, 0)),
        ([reading(unitId="late"), reading(facilityId="1e30"), reading(date="2024-06-02"), reading(date=None)], (2, 1, 1)),
    ]
    for k, (part, want) in enumerate(rounds):
        hourly(spark, *part).write.mode("append").json(landing)
        if k == 2:
            text_file(landing, ".", "{cut short", name="x.json")
        assert tuple(routed.run_daily(spark, landing, root, checkpoint)) == want
        before = as_set(routed.daily_rows(spark, root)), as_set(routed.batches(spark, root))
        if k % 2:
            for _ in range(2):
                routed.compact(spark, root)
                assert (as_set(routed.daily_rows(spark, root)), as_set(routed.batches(spark, root))) == before
            assert not [f for f in routed.daily_rows(spark, root).inputFiles() if "/batch=" in f]
    on_time = {("2024-01-01", "U1"): 20.0, ("2024-06-01", "U1"): 20.0, ("2024-06-02", "U1"): 10.0, ("None", "U1"): 10.0}
    assert state(spark, root) == on_time
    assert state(spark, root, with_late=True) == {**on_time, ("2024-01-01", "late"): 10.0}
    assert [r.unit_id for r in routed.aside(spark, root, "late").collect()] == ["late"]
    assert routed.aside(spark, root, "rejected").count() == 3
    assert tuple(routed.run_daily(spark, landing, root, checkpoint)) == (0, 0, 0), "nothing new"


def test_a_repeated_batch_and_a_stopped_one_change_nothing(spark, path):
    root = path("routed")
    parts = [[reading(), reading(date="2024-06-01")], [reading(), reading(date="2024-06-01"), reading(date="x")]]
    for k, part in enumerate(parts):
        routed.apply_batch(hourly(spark, *part), k, root, routed.newest_date(spark, root, k))
    before = as_set(routed.daily_rows(spark, root)), as_set(routed.batches(spark, root)), as_set(routed.aside(spark, root, "late"))
    routed.apply_batch(hourly(spark, *parts[1]), 1, root, routed.newest_date(spark, root, 1))
    # A batch that stopped before its last row is not there.
    typed = routed.shape_hourly(hourly(spark, reading()))
    typed.write.parquet(f"{root}/aside/batch=2/verdict=late")
    routed.hourly_to_daily(typed).write.parquet(f"{root}/added/batch=2")
    after = as_set(routed.daily_rows(spark, root)), as_set(routed.batches(spark, root)), as_set(routed.aside(spark, root, "late"))
    assert after == before and len(before[2]) == 1
    assert str(routed.newest_date(spark, root, 1)) == "2024-06-01" and routed.newest_date(spark, root, 0) is None
    assert [str(r.bound) for r in routed.batches(spark, root).orderBy("batch").collect()] == ["None", "2024-03-03"]


def test_equal_to_the_batch_roll_up(spark, path):
    landing, root, checkpoint = (path(n) for n in ("landing", "routed", "checkpoint"))
    parts = [
        [reading(), reading(grossLoad=None), reading(facilityId="x"), reading(primaryFuelInfo=None)],
        [reading(), reading(date="2024-03-20"), reading(date="2024-03-20", grossLoad="NaN", unitId="U3")],
        [reading(grossLoad="5"), reading(date="2024-03-20")],
    ]
    for part in parts:
        hourly(spark, *part).write.mode("append").json(landing)
        routed.run_daily(spark, landing, root, checkpoint)
    want = daily_rows(hourly(spark, *sum(parts, [])), RUN_TS).select(*DAILY_KEYS, *MEASURES)
    got = routed.daily_rows(spark, root).withColumn("facility_id", F.col("facility_id").cast("bigint"))
    assert as_set(got) == as_set(want)


def test_nothing_landed_yet(spark, path):
    assert routed.batches(spark, path()).isEmpty() and routed.daily_rows(spark, path(), with_late=True).isEmpty()
    routed.compact(spark, path())


def test_readings_are_counted_however_many_batches_a_run_has(spark, path, setting):
    """Counts come from the rows of the batches, not from the reports of the run, of which Spark keeps the last few."""
    setting("spark.sql.streaming.numRecentProgressUpdates", "2")
    landing, root, checkpoint = (path(n) for n in ("landing", "routed", "checkpoint"))
    place, files = landing.removeprefix("file:"), 12
    os.makedirs(place)
    for k in range(files):
        day = "2024-06-01" if k == 0 else "2024-01-01" if k % 2 else "2024-06-02"
        with open(f"{place}/{k:03d}.json", "w") as f:
            f.write(json.dumps(reading(date=day)))
        os.utime(f"{place}/{k:03d}.json", (1_700_000_000 + k, 1_700_000_000 + k))
    assert tuple(routed.run_daily(spark, landing, root, checkpoint, max_files=1)) == (files // 2, 0, files // 2)
    assert routed.batches(spark, root).count() == files
    assert state(spark, root) == {("2024-06-01", "U1"): 10.0, ("2024-06-02", "U1"): 10.0 * (files // 2 - 1)}
