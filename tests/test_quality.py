import pytest

from gridplume.operators import quality
from gridplume.plans import models
from tests.rows import as_set, daily_row, plan, raw


def stg(spark, *rows):
    return models.stg_cems_daily(raw(spark, *rows))


def test_ten_tests():
    assert sum(len(rules) for rules in quality.RULES.values()) == 10


def test_missing_facility_fails(spark):
    results = quality.check(stg(spark, daily_row(), daily_row(facility_id=None)), "stg_cems_daily")
    assert as_set(results.where("failures > 0")) == [("stg_cems_daily", "facility_id", "not_null", 1)]
    with pytest.raises(quality.QualityError, match="facility_id not_null: 1 rows"):
        quality.quality_gate(results)


def test_unknown_label_fails_and_null_does_not(spark):
    df = spark.createDataFrame([("Coal",), ("Gas",), (None,)], "fuel_category string")
    rule = quality.accepted_values("fuel_category", ["Coal", "Other"])
    assert quality.check(df, "t", [rule]).first().failures == 1


def test_no_rows_no_failures(spark):
    results = quality.check(stg(spark), "stg_cems_daily")
    assert {r.failures for r in results.collect()} == {0}
    quality.quality_gate(results)


def test_all_tests_of_a_table_share_one_pass(spark):
    text = plan(quality.check(stg(spark, daily_row()), "stg_cems_daily"), "simple")
    assert text.count("Exchange") == 1


def test_unknown_test():
    with pytest.raises(ValueError):
        quality.Rule("a", "unique").failure()


def test_upload_gate(spark):
    assert quality.upload_gate(raw(spark, daily_row()))
    assert not quality.upload_gate(raw(spark))
