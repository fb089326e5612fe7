from datetime import date

import pytest
from pyspark.sql import functions as F

from gridplume.operators import profile, shaping
from gridplume.schemas import DAILY_KEYS, MEASURES, RAW
from tests.rows import RUN_TS, hourly, many_rows, plan, reading


def daily(spark, *readings):
    return shaping.hourly_to_daily(shaping.shape_hourly(hourly(spark, *readings)))


def test_readings_add_up(spark):
    row = daily(spark, reading(), reading(grossLoad="5.5"), reading(grossLoad="junk")).first()
    assert row.gross_load_mw == 15.5 and row.co2_mass_tons == 6.0


def test_sum_over_nothing_is_zero(spark):
    row = daily(spark, reading(grossLoad=None), reading(grossLoad="NaN")).first()
    assert row.gross_load_mw == 0.0


def test_missing_keys_form_groups(spark):
    rows = daily(spark, reading(primaryFuelInfo=None), reading(primaryFuelInfo=None), reading(facilityId="x"), reading())
    found = {(r.primary_fuel, r.facility_id): r.gross_load_mw for r in rows.collect()}
    assert found == {(None, 1.0): 20.0, ("Coal", None): 10.0, ("Coal", 1.0): 10.0}


def test_facility_ids_group_as_numbers(spark):
    assert daily(spark, reading(facilityId="7"), reading(facilityId="7.0"), reading(facilityId=" 07 ")).count() == 1


def test_infinities_of_both_signs_cancel_to_nan(spark):
    row = daily(spark, reading(grossLoad="inf"), reading(grossLoad="-inf")).first()
    assert row.gross_load_mw != row.gross_load_mw


def test_bad_date_fails_the_job(spark):
    with pytest.raises(Exception, match="not a date"):
        daily(spark, reading(), reading(date="not-a-date")).collect()


def test_missing_field_is_named(spark):
    with pytest.raises(shaping.MissingFields, match="co2Mass"):
        shaping.select_rename(hourly(spark, reading()).drop("co2Mass"))


def test_extra_fields_are_dropped(spark):
    assert "hour" not in shaping.select_rename(hourly(spark, reading()).withColumn("hour", F.lit(3))).columns


def test_missing_date_stays_in_its_chunk(spark):
    rows = hourly(spark, reading(date=None)).withColumns({"chunk_state": F.lit("TX"), "chunk_year": F.lit(2024), "chunk_month": F.lit(2)})
    row = shaping.daily_rows(rows, RUN_TS).first()
    assert (row.date, row.year, row.month) == (None, 2024, 2)


def test_audit_marks_bad_and_misplaced_rows(spark):
    rows = hourly(
        spark, reading(), reading(date="2024-02-01"), reading(date="oops"), reading(date=None, grossLoad=None),
        reading(stateCode="AK"), reading(stateCode=None),
    )
    folder = {"chunk_state": F.lit("TX"), "chunk_year": F.lit(2024), "chunk_month": F.lit(1)}
    audited = shaping.shape_hourly(rows.withColumns(folder), audited=True)
    assert [(r.state, r.date, r.bad) for r in audited.collect()] == [
        ("TX", date(2024, 1, 1), False), ("TX", date(2024, 2, 1), True), ("TX", None, True), ("TX", None, False),
        ("AK", date(2024, 1, 1), True), (None, date(2024, 1, 1), False),
    ]
    assert audited.collect()[3].named == shaping.ALL_NAMED - (1 << 4) - (1 << 5), "no fifth and no sixth field"
    daily = shaping.daily_rows(rows.withColumns(folder), RUN_TS, audited=True)
    assert daily.agg(F.sum("bad_rows"), F.bit_or("named")).first()[:] == (3, shaping.ALL_NAMED)


def test_stored_rows_have_the_stored_schema_and_one_stamp(spark):
    rows = shaping.daily_rows(hourly(spark, reading(), reading(unitId="U2")), RUN_TS)
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in RAW]
    assert rows.select("ingested_at").distinct().count() == 1


def test_profile_and_head(spark):
    rows = daily(spark, *[reading(facilityId=str(i), date=f"2024-01-0{i}") for i in range(1, 8)], reading(facilityId=None))
    seen = profile.frame_profile(rows).first()
    assert (seen.rows, seen.min_date, seen.max_date) == (8, date(2024, 1, 1), date(2024, 1, 7))
    assert seen.columns == ",".join([*DAILY_KEYS, *MEASURES])
    head = profile.head_sample(rows, DAILY_KEYS)
    assert [r.facility_id for r in head.collect()] == [1.0, 2.0, 3.0, 4.0, 5.0]
    assert "TakeOrderedAndProject" in plan(head)


def test_a_hot_unit_combines_before_the_shuffle(spark):
    """One unit holds all readings: each map task sends one row for it."""
    same = many_rows(spark, 80_000).drop("year", "month").withColumns({"facility_id": F.lit(1), "facility_name": F.lit("P")})
    rolled = shaping.hourly_to_daily(same)
    assert rolled.count() == 1
    text = plan(rolled, "simple")
    assert text.index("partial_sum") > text.index("Exchange"), "the partial sums run below the exchange"


def test_no_python_in_the_roll_up(spark):
    assert "Python" not in plan(shaping.daily_rows(hourly(spark, reading()), RUN_TS)).replace("PythonRDD", "")
