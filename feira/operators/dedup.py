from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, *keys: str) -> DataFrame:
    """One row per key: the smallest by all other columns, left to right, nulls first.

    ``dropDuplicates(keys)`` keeps whichever row a task happened to see first. Taking
    the minimum over the whole remaining row makes the choice the same for any file
    or partition layout. ``min`` combines on the map side, so each task sends at most
    one row per key and a key that holds a large share of the table is not a hot
    reducer. A null key is a key like any other.
    """
    rest = [name for name in df.columns if name not in keys]
    if not rest:
        return df.distinct()
    picked = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_kept"))
    return picked.select(*[name if name in keys else f"_kept.{name}" for name in df.columns])


def distinct_rows(df: DataFrame) -> DataFrame:
    """``distinct`` that always combines copies first and then shuffles by the whole row.

    A plain ``distinct`` adds no shuffle when its input is already partitioned by one of
    its columns, for instance by a join. That ties the join to its partitioning, and
    adaptive execution may then not split a skewed join. Packing the row into one value
    makes the grouping independent of the single columns.
    """
    packed = df.select(F.struct(*df.columns).alias("_row")).distinct()
    return packed.select("_row.*")
