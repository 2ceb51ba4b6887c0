"""Rows laid out along a space-filling curve, so that filters on any of several columns skip files."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Each column is cut into 2^BITS ranges of about as many rows, at borders that are found in a
# sample of about so many rows; the sample is all that the driver sees.
BITS = 6
SAMPLE_ROWS = 20_000
SEED = 42


def borders(df: DataFrame, columns: Sequence[str], bits: int = BITS, rows: int = SAMPLE_ROWS) -> list[list]:
    """For each column up to 2^bits - 1 different values that cut its sampled rows evenly."""
    total = df.count()
    light = df.select(*columns)
    sample = light if total <= rows else light.sample(rows / total, SEED)
    # the sample has a bound in rows: its size varies by a few hundredths about the one asked for
    values = [list(column) for column in zip(*sample.collect(), strict=True)] or [[] for _ in columns]
    found = []
    for column in values:
        known = sorted(value for value in column if value is not None)
        cuts = {known[i * len(known) >> bits] for i in range(1, 1 << bits)} if known else set()
        found.append(sorted(cuts))
    return found


def _rank(value: Column, cuts: Sequence) -> Column:
    """How many of the sorted cuts are not above the value, by halving; null is 0."""

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < F.lit(cuts[middle]), between(low, middle)).otherwise(between(middle + 1, high))

    return F.when(value.isNull(), F.lit(0)).otherwise(between(0, len(cuts)))


def curve_key(columns: Sequence[str], cuts: Sequence[Sequence], bits: int = BITS) -> Column:
    """The ranks of the columns with their bits taken in turn, the first column's highest bit first."""
    key = F.lit(0).cast("long")
    for d, (name, own) in enumerate(zip(columns, cuts, strict=True)):
        rank = _rank(F.col(name), own).cast("long")
        for b in range(bits):
            place = (b + 1) * len(columns) - 1 - d
            key = key + F.shiftleft(F.shiftright(rank, b).bitwiseAND(1), place)
    return key


def along_curve(df: DataFrame, *columns: str, bits: int = BITS) -> DataFrame:
    """The same rows, dealt to ranges of the curve through ``columns`` and sorted along it.

    A file then covers a small range of each column, where an order by one column after the
    other covers a small range of the first and nearly all of the others. Rows of one cell are
    told apart by the columns themselves, so that a cell with many rows is split as well. ``df``
    is read three times: for its number of rows, the sample and the result, so it should be
    stored.
    """
    cuts = borders(df, columns, bits)
    keyed = df.withColumn("_curve", curve_key(columns, cuts, bits))
    order = ["_curve", *columns]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_curve")
