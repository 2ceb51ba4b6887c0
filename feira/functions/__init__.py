"""Column builders. Each returns a native ``Column``; none of them is a UDF."""

from feira.functions.casts import int_or_null, timestamp_or_null
from feira.functions.geo import haversine_km
from feira.functions.keys import date_key, key_text, known_key, surrogate_key
from feira.functions.predicates import (
    non_decreasing,
    non_negative,
    non_negative_or_null,
    within,
)
from feira.functions.text import clean_city

__all__ = [
    "clean_city",
    "date_key",
    "haversine_km",
    "int_or_null",
    "key_text",
    "known_key",
    "non_decreasing",
    "non_negative",
    "non_negative_or_null",
    "surrogate_key",
    "timestamp_or_null",
    "within",
]
