"""Expressions against Python, numpy and pandas as oracles."""

from __future__ import annotations

import sys
import unicodedata

import numpy as np
import pandas as pd
import pytest
from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark import functions as tf


# Each example is a Spark job over many values, so few are enough.
FEW = settings(max_examples=5, deadline=None, phases=[Phase.generate])


EDGES = [schemas.OCCUPANCY_BUCKETS[0][0], *(high for _, high, _ in schemas.OCCUPANCY_BUCKETS)]
LABELS = [label for _, _, label in schemas.OCCUPANCY_BUCKETS]


def evaluate(spark, values, type_name, *expressions):
    """Rows of expressions over a column ``v``, in input order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {type_name}")
    return df.select("i", *(e.alias(f"e{n}") for n, e in enumerate(expressions))).orderBy("i").collect()


def one(spark, values, type_name, expression):
    return [row.e0 for row in evaluate(spark, values, type_name, expression)]


# --- text --------------------------------------------------------------------


def test_strip_removes_every_kind_of_white_space(spark):
    values = ["\t a b \n", " x　", "\x1cx\x1f", "", " ", "​x", None, "x "]
    expected = [None if v is None else v.strip() for v in values]
    assert one(spark, values, "string", tf.strip(F.col("v"))) == expected


def test_strip_matches_python_for_every_character(spark):
    values = [f"{chr(c)}x{chr(c)}" for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) != "Cs"]
    df = spark.createDataFrame(pd.DataFrame({"v": values, "expected": [v.strip() for v in values]}))
    assert df.where(tf.strip(F.col("v")) != F.col("expected")).count() == 0


def test_title_case_starts_words_at_any_non_letter(spark):
    values = ["waterloo-city", "king's cross", "HAMMERSMITH & CITY", "a1b2c", "élan éa", "straße", "ß",
              "ΑΣ", "ǆ x", "東京line", "", None, "x  y", "o'neill_mc-donald"]
    expected = [None if v is None else v.title() for v in values]
    assert one(spark, values, "string", tf.title_case(F.col("v"))) == expected


def test_title_case_matches_python_for_every_alphabet(spark):
    # Left out: four letters whose case changed between Unicode versions.
    letters = sorted(set(range(0x2100)) - {0x019B, 0x0264, 0x10FC, 0x1C8A})
    values = [f"a{chr(c)}b {chr(c)}cd" for c in letters]
    df = spark.createDataFrame(pd.DataFrame({"v": values, "expected": [v.title() for v in values]}))
    assert df.where(tf.title_case(F.col("v")) != F.col("expected")).count() == 0


@FEW
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0x17F, exclude_categories=["Cs"])), min_size=50, max_size=200))
def test_strip_then_title_matches_python(spark, values):
    got = one(spark, values, "string", tf.title_case(tf.strip(F.col("v"))))
    assert got == [v.strip().title() for v in values]


def test_trailing_number(spark):
    values = ["BikePoints_123", "7", "a1b22", "x_007"]
    assert one(spark, values, "string", tf.trailing_number(F.col("v"))) == [123, 7, 22, 7]


@pytest.mark.parametrize("bad", ["BikePoints_", "12x", "", "x99999999999"])
def test_trailing_number_fails_without_an_integer(spark, bad):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, [bad], "string", tf.trailing_number(F.col("v")))


# --- numbers -----------------------------------------------------------------


def test_round2_sends_ties_to_even(spark):
    assert one(spark, [0.125, 0.375, 2.5, 1.005, None], "double", tf.round2(F.col("v"))) == [0.12, 0.38, 2.5, 1.0, None]


@FEW
@given(st.lists(st.one_of(st.integers(-10**9, 10**9).map(lambda n: n / 1000), st.floats(-1e12, 1e12)), min_size=100, max_size=400))
def test_round2_matches_pandas(spark, values):
    got = one(spark, values, "double", tf.round2(F.col("v")))
    assert np.array_equal(np.array(got), pd.Series(values, dtype="float64").round(2).to_numpy())


def test_round2_matches_numpy_on_all_three_decimal_values(spark):
    df = spark.range(200_000).select((F.col("id") / 1000).alias("v"))
    pdf = df.select("v", tf.round2(F.col("v")).alias("r")).toPandas()
    assert np.array_equal(pdf.r.to_numpy(), pdf.v.round(2).to_numpy())


def test_occupancy_without_docks(spark):
    rows = spark.createDataFrame([(0, 0), (1, 0), (2, 0), (1, 3), (2, 3)], "b int, d int")
    got = [r.o for r in rows.select("b", "d", tf.occupancy(F.col("b"), F.col("d")).alias("o")).orderBy("d", "b").collect()]
    assert got == [0.0, 100.0, 200.0, 33.33, 66.67]


def test_buckets_are_closed_on_the_right(spark):
    values = [-1.0, -0.5, 0.0, 0.01, 25.0, 25.01, 75.0, 75.01, 101.0, 101.01, float("nan"), None]
    label = tf.bucket_label(F.col("v"), schemas.OCCUPANCY_BUCKETS, schemas.NO_BUCKET)
    expected = pd.cut(pd.Series(values, dtype="float64"), EDGES, labels=LABELS)
    assert one(spark, values, "double", label) == expected.astype(str).tolist()


@FEW
@given(st.lists(st.floats(-5, 110).map(lambda x: round(x, 2)), min_size=100, max_size=400))
def test_buckets_match_pandas(spark, values):
    label = tf.bucket_label(F.col("v"), schemas.OCCUPANCY_BUCKETS, schemas.NO_BUCKET)
    expected = pd.cut(pd.Series(values), EDGES, labels=LABELS)
    assert one(spark, values, "double", label) == expected.astype(str).tolist()


def test_rate_is_a_double(spark):
    df = spark.createDataFrame([(1, 3)], "a long, b long").select(tf.rate_pct(F.col("a"), F.col("b")).alias("r"))
    assert df.dtypes == [("r", "double")]
    assert df.first().r == 33.33


# --- lookups and casts ---------------------------------------------------------


def test_code_label(spark):
    label = tf.code_label(F.col("v"), schemas.SEVERITY_LABELS, schemas.UNKNOWN_SEVERITY)
    values = [*range(21), -1, None]
    expected = [schemas.SEVERITY_LABELS.get(v, "Unknown") for v in values]
    assert one(spark, values, "int", label) == expected


PROPERTIES = "array<struct<key: string, value: string>>"


def test_last_property_wins_and_absence_is_zero(spark):
    values = [
        [("N", "1"), ("M", "9"), ("N", "2")],
        [("M", "9")],
        [],
        None,
        [("N", None)],
        [("N", "")],
        [("N", " 7 ")],
        [("N", "3"), ("N", None)],
        [("N", "-4")],
    ]
    assert one(spark, values, PROPERTIES, tf.integer_property(F.col("v"), "N")) == [2, 0, 0, 0, 0, 0, 7, 0, -4]


@pytest.mark.parametrize("bad", ["abc", "5.7", " "])
def test_malformed_property_fails(spark, bad):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, [[("N", bad)]], PROPERTIES, tf.integer_property(F.col("v"), "N"))


def test_required(spark):
    assert one(spark, [1], "int", tf.required(F.col("v"), "v is NULL")) == [1]
    with pytest.raises(Exception, match="v is NULL"):
        one(spark, [None], "int", tf.required(F.col("v"), "v is NULL"))


def test_utc_date_and_hour_match_the_calendar(spark):
    """Also before 1970, in the last microsecond of a day, and for the first and last years."""
    days = ["0001-01-01", "1582-10-04", "1582-10-15", "1899-12-31", "1969-12-31", "1970-01-01", "2024-02-29", "9999-12-31"]
    texts = [f"{day} {time}" for day in days for time in ("00:00:00", "00:59:59.999999", "12:00:00.000001", "23:59:59.999999")]
    instant = F.col("v").cast("timestamp")
    found = evaluate(spark, [*texts, None], "string", tf.utc_date(instant), tf.utc_hour(instant), F.to_date(instant), F.hour(instant))
    assert [(row.e0, row.e1) for row in found] == [(row.e2, row.e3) for row in found]
    assert found[-1].e0 is None and len(found) == len(texts) + 1


def test_texts_with_plain_ends(spark):
    values = ["  a b  ", " \ta ", "a", "~!", " \x7fa ", "", "   ", " x ", " é", "ḱ -x", "o'neill  st-pancras\t2nd", None]
    values += ["a" + chr(c) + "b" + chr(c) + chr(c) + "C " for c in range(128)]
    assert one(spark, values, "string", tf.strip(F.col("v"))) == [None if v is None else v.strip() for v in values]
    assert one(spark, values, "string", tf.title_case(F.col("v"))) == [None if v is None else v.title() for v in values]
