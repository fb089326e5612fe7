"""Fixed schemas and value lists. Nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T

# Source field -> column of the daily row.
SOURCE_FIELDS = {
    "stateCode": "state",
    "facilityName": "facility_name",
    "facilityId": "facility_id",
    "unitId": "unit_id",
    "date": "date",
    "grossLoad": "gross_load_mw",
    "so2Mass": "so2_mass_lbs",
    "co2Mass": "co2_mass_tons",
    "noxMass": "nox_mass_lbs",
    "heatInput": "heat_input_mmbtu",
    "primaryFuelInfo": "primary_fuel",
    "unitType": "unit_type",
}

# Measures, in the order of the daily row.
MEASURES = ["gross_load_mw", "so2_mass_lbs", "co2_mass_tons", "nox_mass_lbs", "heat_input_mmbtu"]

# What identifies one daily unit row.
DAILY_KEYS = ["state", "facility_name", "facility_id", "unit_id", "date", "primary_fuel", "unit_type"]

# The order in which the marts list their totals.
TOTALS = ["gross_load_mw", "co2_mass_tons", "so2_mass_lbs", "nox_mass_lbs", "heat_input_mmbtu"]

# A fuel text belongs to the first label whose lower-case form it contains.
FUEL_LABELS = ["Natural Gas", "Coal", "Oil", "Nuclear", "Solar", "Wind", "Biomass", "Hydro"]
OTHER_FUEL = "Other"

# The 50 states.
STATES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME",
    "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA",
    "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
]

# One (state, year, month) is the unit of fetch, storage and replacement.
CHUNK = ["state", "year", "month"]

# Readings are kept as text until they are coerced: the source mixes numbers, text and nulls.
HOURLY = T.StructType([T.StructField(name, T.StringType()) for name in SOURCE_FIELDS])

DAILY = T.StructType(
    [
        T.StructField("state", T.StringType()),
        T.StructField("facility_name", T.StringType()),
        T.StructField("facility_id", T.LongType()),
        T.StructField("unit_id", T.StringType()),
        T.StructField("date", T.DateType()),
        *[T.StructField(name, T.DoubleType()) for name in MEASURES],
        T.StructField("primary_fuel", T.StringType()),
        T.StructField("unit_type", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)

MONTH_KEYS = T.StructType([T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])

# Daily rows as stored: the lake and the raw table carry the chunk's year and month as partition keys.
RAW = T.StructType(DAILY.fields + MONTH_KEYS.fields)

LEDGER = T.StructType(
    [
        T.StructField("chunk_key", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("run_ts", T.TimestampType()),
    ]
)
