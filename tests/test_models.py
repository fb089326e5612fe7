from datetime import date

import pytest
from pyspark.sql import functions as F

from gridplume.functions.fuels import fuel_category
from gridplume.plans import models, tiles
from gridplume.schemas import MEASURES, RAW
from tests.rows import as_set, daily_row, many_rows, plan, raw


@pytest.mark.parametrize(
    "fuel, label",
    [
        ("Coal, Natural Gas", "Natural Gas"), ("Pipeline Natural Gas", "Natural Gas"), ("Boiler", "Oil"),
        ("Diesel OIL", "Oil"), ("Petroleum Coke", "Other"), ("Coal Refuse", "Coal"), ("NUCLEAR", "Nuclear"),
        ("solar", "Solar"), ("Wind", "Wind"), ("Biomass", "Biomass"), ("hydro", "Hydro"), ("Wood", "Other"),
        ("", "Other"), (None, "Other"),
    ],
)
def test_fuel_category(spark, fuel, label):
    assert spark.createDataFrame([(fuel,)], "f string").select(fuel_category(F.col("f"))).first()[0] == label


def marts(rows):
    known = {"raw_cems_daily": rows}
    return [models.source_ref(name, known) for name in models.MARTS]


def test_staging_cleans(spark):
    rows = raw(spark, daily_row(gross_load_mw=None), daily_row(date=None), daily_row(state=None), daily_row(facility_id=None))
    stg = models.stg_cems_daily(rows)
    assert stg.columns == [
        "state", "facility_name", "facility_id", "unit_id", "date", "primary_fuel", "unit_type", *MEASURES, "ingested_at",
    ]
    assert {(r.facility_id, r.gross_load_mw) for r in stg.collect()} == {(1, 0.0), (None, 10.0)}


def test_plant_with_two_fuels_counts_twice(spark):
    rows = raw(spark, daily_row(), daily_row(primary_fuel="Diesel Oil", unit_id="U2"))
    over_time, by_fuel = marts(rows)
    assert over_time.first().facility_count == 2
    assert {(r.fuel_category, r.facility_count) for r in by_fuel.collect()} == {("Coal", 1), ("Oil", 1)}
    assert models.facility_count_exact(models.stg_cems_daily(rows)).first().facility_count_exact == 1


def test_same_category_from_two_texts_counts_twice(spark):
    rows = raw(spark, daily_row(), daily_row(primary_fuel="Coal Refuse"))
    assert marts(rows)[1].first().facility_count == 2


def test_missing_facility_adds_to_sums_but_not_to_the_count(spark):
    rows = raw(spark, daily_row(), daily_row(facility_id=None))
    row = marts(rows)[0].first()
    assert (row.facility_count, row.total_gross_load_mw) == (1, 20.0)


def test_marts_hold_every_measure_whole(spark):
    rows = many_rows(spark, 5000)
    for mart in marts(rows):
        for m in MEASURES:
            got, want = mart.agg(F.sum(f"total_{m}")).first()[0], rows.agg(F.sum(m)).first()[0]
            assert got == pytest.approx(want)


def test_mart_columns(spark):
    totals = ["total_gross_load_mw", "total_co2_mass_tons", "total_so2_mass_lbs", "total_nox_mass_lbs", "total_heat_input_mmbtu"]
    over_time, by_fuel = marts(raw(spark))
    assert over_time.columns == ["date", "state", *totals, "facility_count"]
    assert by_fuel.columns == ["date", "state", "fuel_category", *totals, "facility_count"]


def test_unknown_model(spark):
    with pytest.raises(KeyError):
        models.source_ref("nothing", {})


def test_views_and_table(spark, path):
    rows = raw(spark, daily_row(), daily_row(unit_id="U2"))
    models.model_views(spark, rows)
    assert spark.sql("select count(*) from stg_cems_daily").first()[0] == 2
    assert spark.sql("select facility_count from int_cems_aggregated").first()[0] == 1
    name = "unit_marts.mart_emissions_over_time"
    for _ in range(2):
        models.model_table(marts(rows)[0], name)
    assert spark.table(name).count() == 1
    models.model_table(marts(rows)[0], "unit_marts.elsewhere", path("mart"))
    assert as_set(spark.table("unit_marts.elsewhere")) == as_set(spark.table(name))


def test_tiles(spark):
    rows = raw(
        spark, daily_row(), daily_row(state="AK"), daily_row(date=date(2024, 1, 2)),
        daily_row(date=date(2025, 1, 2), primary_fuel="Wind", gross_load_mw=30.0),
        daily_row(date=date(2025, 1, 2), gross_load_mw=10.0),
    )
    over_time, by_fuel = marts(rows)
    assert {(r.date, r.total_gross_load_mw) for r in tiles.daily_generation(over_time).collect()} == {
        (date(2024, 1, 1), 20.0), (date(2024, 1, 2), 10.0), (date(2025, 1, 2), 40.0),
    }
    ranged = tiles.daily_generation_by_state(over_time, date(2024, 1, 1), date(2024, 1, 1))
    assert as_set(ranged) == [(date(2024, 1, 1), "AK", 10.0), (date(2024, 1, 1), "TX", 10.0)]
    assert tiles.daily_generation(over_time, last=date(2024, 1, 1)).count() == 1
    shares = {(r.year, r.fuel_category): r.share for r in tiles.fuel_share(by_fuel).collect()}
    assert shares == {(2024, "Coal"): 1.0, (2025, "Wind"): 0.75, (2025, "Coal"): 0.25}


def test_one_measure_reads_few_columns(spark, path):
    place = path("raw")
    many_rows(spark, 100).write.parquet(place)
    over_time = marts(spark.read.schema(RAW).parquet(place))[0]
    text = plan(tiles.daily_generation(over_time, date(2024, 1, 1), date(2024, 1, 31)))
    assert "ReadSchema: struct<state:string,date:date,gross_load_mw:double,primary_fuel:string>" in text
    assert "GreaterThanOrEqual(date,2024-01-01)" in text, "the date filter reaches the scan through both sums"
    assert "facility_id" not in text.split("ReadSchema")[1].split("\n")[0]


def test_views_of_both_layers_give_the_models_rows(spark, path):
    from gridplume.sources import lake

    rows = raw(spark, daily_row(), daily_row(gross_load_mw=None, facility_id=2), daily_row(state=None), daily_row(date=None))
    table = path("raw")
    lake.load_truncate(rows, table)
    models.layer_views(spark, table, "layers")
    known = {"raw_cems_daily": lake.raw_table(spark, table)}
    for name, view in (("stg_cems_daily", "layers_staging.stg_cems_daily"), ("int_cems_aggregated", "layers_intermediate.int_cems_aggregated")):
        model, stored = models.source_ref(name, known), spark.table(view)
        assert as_set(stored.select(*model.columns)) == as_set(model) and set(stored.columns) == set(model.columns)
