import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marginalia.functions import bands, numbers
from marginalia.functions import text as t

TIES = [2.675, 0.005, 0.015, 0.03125, 0.00625, 1.005, 2.5, 3.5, -2.675, -0.5, 1e-9, 0.0, 99.995, 12.345, 1 / 3, 250.125]


def one(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


@pytest.mark.parametrize("digits", [1, 2, 3, 4])
def test_rounding_is_that_of_the_binary_value(spark, digits):
    got = one(spark, [(v,) for v in TIES], "x double", numbers.round_exact(F.col("x"), digits))
    assert got == [round(v, digits) + 0.0 for v in TIES]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 40000), st.integers(1, 40000)), min_size=1, max_size=200))
def test_rounding_of_percentages(spark, pairs):
    got = one(spark, [(a / b * 100,) for a, b in pairs], "x double", numbers.round_exact(F.col("x"), 2))
    assert got == [round(a / b * 100, 2) for a, b in pairs]


def test_percent_of_nothing_is_zero(spark):
    assert one(spark, [(0, 0), (1, 8)], "a long, b long", numbers.percent(F.col("a"), F.col("b"))) == [0.0, 12.5]


def test_confidence_coercion(spark):
    words = ["0.5", " 0.25 ", "", "abc", "nan", "NaN", None, "1e-2", "-3", "+.5", "5.", "1.0d", "2f", "0x1p3", "inf"]
    got = one(spark, [(w,) for w in words], "x string", numbers.coerce_confidence(F.col("x")))
    assert got == [0.5, 0.25, 0, 0, 0, 0, 0, 0.01, -3, 0.5, 5, 0, 0, 0, math.inf]


def test_bool_coercion(spark):
    words = ["True", "1", "true", "False", "0", "", "yes", "TRUE", None]
    got = one(spark, [(w,) for w in words], "x string", numbers.coerce_bool(F.col("x")))
    assert got == [True, True, True, False, False, False, False, False, False]


PADDED = ["  a b ", " x ", "\x1c y\x85", "​z", "\r\n\r\n", "", "a  b", " ﻿q ", "İ Σ", "TAB\tIN"]


def test_strip_and_normalise_follow_unicode_whitespace(spark):
    import re

    rows = [(p,) for p in PADDED]
    assert one(spark, rows, "x string", t.strip(F.col("x"))) == [p.strip() for p in PADDED]
    assert one(spark, rows, "x string", t.is_blank(F.col("x"))) == [not p.strip() for p in PADDED]
    assert one(spark, rows, "x string", t.normalise(F.col("x"))) == [
        re.sub(r"\s+", " ", p.lower().strip()) for p in PADDED
    ]


def test_text_predicates(spark):
    rows = ["THIS IS LOUD TEXT", "THIS IS LOUD TEXt", "SHORT", "1234567890123", "ÀÉÎ ÕÜ ŠŽ ĐĐĐ", "ABCDEFGHIJK ǅ",
            "ABCDEFGHIJ ª", "             A"]
    got = one(spark, [(x,) for x in rows], "x string", t.is_shouting(F.col("x")))
    assert got == [x.isupper() and len(x.strip()) > 10 for x in rows]
    assert one(spark, [("a!?!",), ("a!?",)], "x string", t.has_excess_punctuation(F.col("x"))) == [True, False]
    assert one(spark, [("a�",), ("a",)], "x string", t.has_replacement_char(F.col("x"))) == [True, False]
    assert one(spark, [("a😊",)], "x string", t.text_length(F.col("x"))) == [2]


def test_bands_are_half_open(spark):
    values = [-0.1, 0.0, 0.1999, 0.2, 0.4, 0.6, 0.8, 1.0]
    rows = [(v,) for v in values]
    assert one(spark, rows, "x double", bands.interpret_kappa(F.col("x"))) == [
        "Poor (worse than chance)", "Slight", "Slight", "Fair", "Moderate", "Substantial", "Almost Perfect",
        "Almost Perfect",
    ]
    assert one(spark, rows, "x double", bands.override_band(F.col("x"))) == [
        None, "0%–20%", "0%–20%", "20%–40%", "40%–70%", "40%–70%", "≥70%", "≥70%",
    ]
    assert one(spark, [(0.0,), (0.1,), (0.2,), (0.5,), (0.8,)], "x double", bands.review_tier(F.col("x"))) == [
        "0%", "1–20%", "20–50%", "50–80%", "80–100%",
    ]
