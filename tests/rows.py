"""Hand-made rows, and helpers to look at plans."""

import contextlib
import io
from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from gridplume.schemas import HOURLY, RAW

RUN_TS = datetime(2024, 3, 5, 6, tzinfo=timezone.utc)


def reading(**changes):
    base = {
        "stateCode": "TX", "facilityName": "Plant", "facilityId": "1", "unitId": "U1", "date": "2024-01-01",
        "grossLoad": "10", "so2Mass": "1", "co2Mass": "2", "noxMass": "3", "heatInput": "4",
        "primaryFuelInfo": "Coal", "unitType": "Boiler",
    }
    return {**base, **changes}


def hourly(spark, *readings):
    return spark.createDataFrame([tuple(r.get(f) for f in HOURLY.names) for r in readings], HOURLY)


def daily_row(**changes):
    base = {
        "state": "TX", "facility_name": "Plant", "facility_id": 1, "unit_id": "U1", "date": date(2024, 1, 1),
        "gross_load_mw": 10.0, "so2_mass_lbs": 1.0, "co2_mass_tons": 2.0, "nox_mass_lbs": 3.0, "heat_input_mmbtu": 4.0,
        "primary_fuel": "Coal", "unit_type": "Boiler", "ingested_at": RUN_TS, "year": 2024, "month": 1,
    }
    return {**base, **changes}


def raw(spark, *rows):
    return spark.createDataFrame([tuple(r[f] for f in RAW.names) for r in rows], RAW)


def many_rows(spark, n, tasks=16):
    """``n`` daily rows of one single chunk."""
    columns = {f.name: F.lit(daily_row()[f.name]).cast(f.dataType) for f in RAW}
    columns |= {"facility_id": F.col("id"), "gross_load_mw": F.rand(1), "facility_name": F.col("id").cast("string")}
    return spark.range(0, n, 1, tasks).select(*[columns[f.name].alias(f.name) for f in RAW])


def plan(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def as_set(df):
    return sorted(map(tuple, df.collect()), key=repr)
