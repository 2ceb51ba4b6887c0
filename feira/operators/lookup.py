from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def translate_or_keep(df: DataFrame, lookup: DataFrame, name: str, translated: str) -> DataFrame:
    """Replace ``name`` by its ``translated`` value from ``lookup``; keep it where there is none.

    The new column moves to the end. A lookup with repeated keys repeats the rows.
    Spark broadcasts the lookup when its size is below the session's threshold.
    """
    joined = df.join(lookup.select(name, translated), name, "left")
    others = [c for c in df.columns if c != name]
    return joined.select(*others, F.coalesce(translated, name).alias(name))
