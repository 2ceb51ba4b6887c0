"""Gold to customer segments: recency, frequency, monetary value and k-means on them."""

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.sources.working import store

# Number of segments and seed.
SEGMENT_COUNT = 4
SEED = 42

# Number of partitions that k-means starts from. It decides which rows are drawn first, so
# it is a fixed value and not an option of the session.
LAYOUT_PARTITIONS = 32

PERSON = ["customer_unique_id", "customer_city", "customer_state"]
FEATURES = ["Recency", "Frequency", "Monetary"]


def rfm_totals(sales: DataFrame, dates: DataFrame, customers: DataFrame) -> DataFrame:
    """Per person: the last day with a sale, the number of sold items and the sum paid.

    Items are counted, not orders, and the order total stands on each item, so an order
    of n items adds it n times.

    Sales are reduced to one row per customer key before customers are joined: what is
    shuffled are partial sums, and a customer with very many sales is one row by then.
    """
    per_key = (
        sales.select("customer_key", "date_key", "sale_key", "payment_value")
        .join(dates.select("date_key", "full_date"), "date_key")
        .groupBy("customer_key")
        .agg(
            F.max("full_date").alias("last_day"),
            F.count("sale_key").alias("items"),
            F.sum("payment_value").alias("paid"),
        )
    )
    return (
        per_key.join(customers.select("customer_key", *PERSON), "customer_key")
        .groupBy(*PERSON)
        .agg(
            F.max("last_day").alias("last_day"),
            F.sum("items").alias("Frequency"),
            F.sum("paid").alias("Monetary"),
        )
    )


def _state(totals: DataFrame) -> Column:
    """What all rows together say: the newest day, and each feature's mean and deviation.

    One aggregate of states that are merged, so each task sends one row. It is a scalar
    subquery: ``totals`` is read twice, so it should be stored first.
    """
    features = [F.unix_date("last_day"), F.col("Frequency"), F.coalesce("Monetary", F.lit(0))]
    moments = []
    for name, value in zip(FEATURES, features, strict=True):
        number = value.cast("double")
        moments += [F.avg(number).alias(f"{name}_mean"), F.stddev_samp(number).alias(f"{name}_std")]
    state = F.struct(F.max("last_day").alias("newest"), *moments)
    return totals.agg(state.alias("state")).scalar()


def rfm_features(totals: DataFrame) -> DataFrame:
    """Recency in days, counted from the day after the newest sale of all; null becomes 0."""
    recency = F.datediff(F.date_add(_state(totals)["newest"], 1), "last_day")
    return totals.select(*PERSON, recency.alias("Recency"), "Frequency", "Monetary").fillna(0)


def rfm_scaled(totals: DataFrame) -> DataFrame:
    """Each feature of ``rfm_features`` less its mean, over its sample standard deviation, as
    ``Recency_z`` and so on; 0 where all persons have the same value, or there is only one.

    Recency falls as the last day rises, by the same steps, so its mean and deviation come from
    the days themselves and nothing has to be known before the one aggregate.
    """
    state = _state(totals)
    monetary = F.coalesce("Monetary", F.lit(0))
    less_mean = {
        "Recency": state["Recency_mean"] - F.unix_date("last_day"),
        "Frequency": F.col("Frequency") - state["Frequency_mean"],
        "Monetary": monetary.cast("double") - state["Monetary_mean"],
    }
    scaled = [
        F.when(state[f"{name}_std"] > 0, difference / state[f"{name}_std"]).otherwise(0.0).alias(f"{name}_z")
        for name, difference in less_mean.items()
    ]
    return totals.select(*PERSON, *scaled)


def with_vector(features: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="raw_vector").transform(features)


def standardise(features: DataFrame) -> DataFrame:
    """Add ``vector``: each feature less its mean, over its sample standard deviation."""
    assembled = with_vector(features)
    scaler = StandardScaler(inputCol="raw_vector", outputCol="vector", withMean=True, withStd=True)
    return scaler.fit(assembled).transform(assembled).drop("raw_vector")


def scaled_columns(features: DataFrame) -> DataFrame:
    """The standardised features as plain columns ``Recency_z`` and so on."""
    values = vector_to_array("vector")
    return standardise(features).select(
        *PERSON, *[values[i].alias(f"{name}_z") for i, name in enumerate(FEATURES)]
    )


def fit_segments(
    features: DataFrame,
    k: int = SEGMENT_COUNT,
    seed: int = SEED,
    partitions: int = LAYOUT_PARTITIONS,
    folder: str | None = None,
) -> tuple[DataFrame, list[list[float]]]:
    """The features with ``vector`` (standardised) and ``Cluster``, and the clusters' centres.

    k-means starts from rows drawn per partition, so its result depends on the layout.
    What the fit reads is laid out right before it: hashed by person into a fixed number
    of partitions and sorted, whatever the files, their sizes or the number of cores.
    With a working ``folder`` the features are stored there first, so that a lost
    executor costs a file read; the result reads them too, so the folder has to last
    until it has been written. The laid-out features are kept for the passes of the fit.
    Clusters are numbered by rising monetary value of their centres. No rows in, no
    rows out.
    """
    source = features if folder is None else store(features, "rfm_features", folder)
    laid_out = source.repartition(partitions, *PERSON).sortWithinPartitions(*PERSON)
    kept = laid_out.persist()
    if kept.isEmpty():
        nothing = with_vector(kept).withColumnRenamed("raw_vector", "vector")
        return nothing.withColumn("Cluster", F.lit(None).cast("int")), []
    scaled = standardise(kept)
    # the block solver fails when there are fewer different rows than clusters
    kmeans = KMeans(
        k=k, seed=seed, featuresCol="vector", predictionCol="_raw_cluster", solver="row"
    )
    model = kmeans.fit(scaled)
    centres = model.clusterCenters()
    by_value = sorted(range(len(centres)), key=lambda i: tuple(centres[i][::-1]))
    number = F.array(*[F.lit(by_value.index(i)) for i in range(len(centres))])
    if folder is not None:
        kept.unpersist()
    clustered = model.transform(scaled).select(
        *features.columns, "vector", number[F.col("_raw_cluster")].cast("int").alias("Cluster")
    )
    return clustered, [list(map(float, centres[i])) for i in by_value]


def segment(
    features: DataFrame,
    k: int = SEGMENT_COUNT,
    seed: int = SEED,
    partitions: int = LAYOUT_PARTITIONS,
    folder: str | None = None,
) -> DataFrame:
    """Add ``Cluster``: k-means on the standardised features, see ``fit_segments``."""
    return fit_segments(features, k, seed, partitions, folder)[0].drop("vector")


def checked_segments(features: DataFrame, folder: str | None = None) -> DataFrame:
    """The features with what must hold of their clusters, as computed from a fit.

    The cluster has one of the numbers, its centre is the nearest one, and the centres
    are in the order of their monetary value.
    """
    clustered, centres = fit_segments(features, folder=folder)
    ordered = all(a[-1] <= b[-1] for a, b in zip(centres, centres[1:], strict=False))
    place = vector_to_array("vector")
    distances = F.array(
        *[sum((F.pow(place[i] - F.lit(x), 2) for i, x in enumerate(c)), F.lit(0.0)) for c in centres]
    )
    own = F.get(distances, F.col("Cluster"))
    return clustered.select(
        *features.columns,
        F.coalesce(F.col("Cluster").between(0, SEGMENT_COUNT - 1), F.lit(False)).alias("in_range"),
        F.coalesce(own <= F.array_min(distances) + 1e-9, F.lit(False)).alias("is_nearest"),
        F.lit(ordered).alias("centres_in_order"),
    )
