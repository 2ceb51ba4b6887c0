"""Row filters as one boolean Column each (a filter keeps only rows that are TRUE)."""

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def non_decreasing(*names: str) -> Column:
    """Each column is at least the one before it; a null column passes its own check.

    A null on the left of a non-null column makes that pair unknown, so such a row
    is not kept: a parcel cannot reach the carrier before the order is approved.
    """
    return reduce(
        and_,
        [
            (F.col(earlier) <= F.col(later)) | F.col(later).isNull()
            for earlier, later in zip(names, names[1:])
        ],
    )


def non_negative(*names: str) -> Column:
    return reduce(and_, [F.col(name) >= 0 for name in names])


def non_negative_or_null(*names: str) -> Column:
    return reduce(and_, [(F.col(name) >= 0) | F.col(name).isNull() for name in names])


def within(name: str, low, high) -> Column:
    """Closed range; null is not in it."""
    return F.col(name).between(low, high)
