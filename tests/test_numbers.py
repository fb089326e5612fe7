import math

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridplume.functions import numbers

TEXTS = [
    " 12 ", "1e3", "inf", "", "abc", "1,000", "0x10", "0x1p3", "1d", "1f", "1D", "1F", "1.f", "1e3d", "1d ", "true",
    "NaN", "nan", "-nan", None, "-inf", "+Infinity", "iNf", " inf ", "infi", "inff", "1e999f", "1e400", "-1e400",
    "1e-400", ".5", "5.", ".", "--1", "+1", "+ 1", "1 2", "-0", "1e+3", "1e3.5", "  ", "1_000", "1L", "\t3\n",
    "123456789012345678901234567890", "1.7976931348623157e308", "4.9e-324", "-.5e-3", "None", "NULL", "00012",
]


def ours(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = df.withColumn("v", numbers.parsed(F.col("t")))
    kept = found.select("i", numbers.plain(F.col("v"), F.col("t"), T.StringType()).alias("v"))
    return [r.v for r in kept.orderBy("i").collect()]


def wanted(text):
    value = pd.to_numeric(pd.Series([text], dtype=object), errors="coerce").iloc[0]
    return None if value is None or math.isnan(value) else float(value)


def test_text_as_pandas_reads_it(spark):
    assert dict(zip(TEXTS, ours(spark, TEXTS))) == {t: wanted(t) for t in TEXTS}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("0123456789+-.eEdDfFxXinfaINFA ,_", max_size=8), min_size=200, max_size=400))
def test_any_text_as_pandas_reads_it(spark, texts):
    assert ours(spark, texts) == [wanted(t) for t in texts]


def test_numeric_column_keeps_values_but_nan(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (None,), (float("inf"),)], "v double")
    kept = df.select(numbers.plain(numbers.parsed(F.col("v")), F.col("v"), T.DoubleType()).alias("v"))
    assert [r.v for r in kept.collect()] == [1.5, None, None, float("inf")]


@pytest.mark.parametrize("value, rounded", [(2.5, 3), (-2.5, -3), (2.4, 2), (7.0, 7), (None, None)])
def test_ids_round_half_away_from_zero(spark, value, rounded):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(numbers.to_id(F.col("v"))).first()[0] == rounded
