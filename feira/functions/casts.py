"""Casts that give null for text they cannot read, with ANSI mode left on."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def timestamp_or_null(name: str) -> Column:
    return F.col(name).try_cast("timestamp")


def int_or_null(name: str) -> Column:
    """Truncate towards zero. Goes through double so that text '12.7' reads as 12."""
    return F.col(name).try_cast("double").try_cast("int")
