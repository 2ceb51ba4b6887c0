import hashlib
from datetime import datetime

import pytest
from tests.conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feira.functions import (
    clean_city,
    date_key,
    haversine_km,
    int_or_null,
    non_decreasing,
    non_negative,
    non_negative_or_null,
    surrogate_key,
    timestamp_or_null,
    within,
)
from feira.functions.text import ACCENTED, PLAIN


def values(df, column):
    return [row[0] for row in df.select(column).collect()]


@pytest.mark.parametrize(
    "city, cleaned",
    [
        ("São Paulo", "sao paulo"),
        (" 123 ", ""),
        ("RIO 2 DE JANEIRO", "rio  de janeiro"),
        ("Ñuñoa", "ñuñoa"),
        ("Açaí", "acai"),
        ("\tnatal\t", "\tnatal\t"),
        ("4o Centenário", "o centenario"),
        (None, None),
    ],
)
def test_clean_city(frame, city, cleaned):
    assert values(frame("city string", (city,)), clean_city("city")) == [cleaned]


def test_accent_lists_pair_up():
    assert len(ACCENTED) == len(PLAIN) == len(set(ACCENTED)) == 23


@settings(
    max_examples=20,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(st.lists(st.text(max_size=20), min_size=1, max_size=30))
def test_clean_city_is_idempotent(frame, cities):
    once = frame("city string", *[(c.replace("\x00", ""),) for c in cities]).select(
        clean_city("city").alias("city")
    )
    changed = once.filter(clean_city("city") != F.col("city"))
    assert changed.count() == 0


def test_surrogate_key_hashes_joined_text(frame):
    df = frame("a string, b int, c string", ("x", 1, "z"))
    expected = hashlib.sha256(b"x||1||z").hexdigest()
    assert values(df, surrogate_key("a", "b", "c")) == [expected]


def test_surrogate_key_skips_nulls(frame):
    df = frame("a string, b string, c string", ("x", None, "z"), ("x", "z", None))
    first, second = values(df, surrogate_key("a", "b", "c"))
    assert first == second == hashlib.sha256(b"x||z").hexdigest()


def test_surrogate_key_of_null_is_hash_of_empty(frame):
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert values(frame("a string", (None,), ("",)), surrogate_key("a")) == [empty, empty]


def test_date_key(frame):
    df = frame("t timestamp", (datetime(2016, 2, 29, 23, 59),), (None,))
    assert values(df, date_key("t")) == ["20160229", None]


@pytest.mark.parametrize(
    "text, number",
    [("12.7", 12), ("-12.7", -12), ("12", 12), ("abc", None), ("", None), (None, None)],
)
def test_int_or_null(frame, text, number):
    assert values(frame("x string", (text,)), int_or_null("x")) == [number]


@pytest.mark.parametrize(
    "text, moment",
    [
        ("2017-01-02 03:04:05", datetime(2017, 1, 2, 3, 4, 5)),
        ("2017-01-02", datetime(2017, 1, 2)),
        ("", None),
        ("soon", None),
        (None, None),
    ],
)
def test_timestamp_or_null(frame, text, moment):
    df = frame("x string", (text,)).select(timestamp_or_null("x").cast("timestamp_ntz"))
    assert df.first()[0] == moment


@pytest.mark.parametrize(
    "stages, kept",
    [
        ((1, 2, 3, 4), True),
        ((1, 1, 1, 1), True),
        ((1, None, None, None), True),
        ((1, 2, None, None), True),
        ((1, 2, 3, None), True),
        ((None, None, None, None), True),
        ((None, 2, 3, 4), False),
        ((1, None, 3, 4), False),
        ((1, 2, None, 4), False),
        ((2, 1, 3, 4), False),
        ((1, 3, 2, 4), False),
        ((1, 2, 4, 3), False),
    ],
)
def test_non_decreasing(frame, stages, kept):
    df = frame("a int, b int, c int, d int", stages)
    assert df.filter(non_decreasing("a", "b", "c", "d")).count() == int(kept)


def test_non_negative(frame):
    df = frame("a double, b double", (0.0, 1.0), (-0.01, 1.0), (None, 1.0), (2.0, None))
    assert rows(df.filter(non_negative("a", "b"))) == [(0.0, 1.0)]
    assert rows(df.filter(non_negative_or_null("a", "b"))) == [(0.0, 1.0), (2.0, None), (None, 1.0)]


def test_within_is_closed(frame):
    df = frame("a double", (90.0,), (90.0001,), (-90.0,), (None,))
    assert rows(df.filter(within("a", -90, 90))) == [(-90.0,), (90.0,)]


@pytest.mark.parametrize(
    "points, km",
    [
        ((-23.55, -46.63, -22.9, -43.2), 357.855),
        ((0.0, 0.0, 0.0, 180.0), 20015.087),
        ((10.0, 20.0, 10.0, 20.0), 0.0),
        ((None, 20.0, 10.0, 20.0), None),
        ((10.0, 20.0, 10.0, None), None),
    ],
)
def test_haversine_km(frame, points, km):
    df = frame("a double, b double, c double, d double", points)
    got = values(df, haversine_km("a", "b", "c", "d"))[0]
    assert got is None if km is None else got == pytest.approx(km, abs=1e-3)


def test_functions_use_no_python_workers(frame):
    df = frame("a string, b double", ("x", 1.0)).select(
        clean_city("a"), surrogate_key("a", "b"), haversine_km("b", "b", "b", "b"), int_or_null("a")
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
