from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# First and last day of the default calendar.
FIRST_DAY = date(2016, 1, 1)
LAST_DAY = date(2019, 12, 31)


def days_between(spark: SparkSession, first: date = FIRST_DAY, last: date = LAST_DAY) -> DataFrame:
    """One row per day in ``full_date``, both ends included."""
    span = spark.range(1).select(F.lit(first).alias("first_day"), F.lit(last).alias("last_day"))
    return _unfold(span)


def days_spanned(df: DataFrame, moment: str) -> DataFrame:
    """One row per day from the earliest to the latest value of a date or time column."""
    day = F.to_date(moment)
    return _unfold(df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day")))


def _unfold(span: DataFrame) -> DataFrame:
    return span.select(F.explode(F.sequence("first_day", "last_day")).alias("full_date"))
