from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _squared_distance(features: Sequence[str], centre: Sequence[float]) -> Column:
    terms = [F.pow(F.col(name) - F.lit(float(at)), 2) for name, at in zip(features, centre)]
    return sum(terms[1:], terms[0])


def assign_nearest(
    df: DataFrame,
    features: Sequence[str],
    centres: Sequence[Sequence[float]],
    cluster_column: str = "Cluster",
) -> DataFrame:
    """Add the index of the nearest of a few given centres; a tie goes to the lower index."""
    distances = F.array(*[_squared_distance(features, centre) for centre in centres])
    nearest = F.array_position(distances, F.array_min(distances)) - 1
    return df.withColumn(cluster_column, nearest.cast("int"))
