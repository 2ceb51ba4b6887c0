"""Bronze to silver: typed, valid, one row per key. One function per table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feira.functions import (
    clean_city,
    int_or_null,
    non_decreasing,
    non_negative,
    non_negative_or_null,
    timestamp_or_null,
    within,
)
from feira.operators import dropped_by_rule, keep_first, translate_or_keep

# The stages an order passes through, in the order they must happen.
ORDER_STAGES = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
]
ESTIMATE = "order_estimated_delivery_date"

# The export misspells two column names.
RESPELLED = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}
PRODUCT_COUNTS = ["product_name_length", "product_description_length", "product_photos_qty"]
PRODUCT_SIZES = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]


def _with_timestamps(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: timestamp_or_null(name) for name in names})


def customers(bronze: DataFrame) -> DataFrame:
    """One row per account, with a city name that is not empty once cleaned.

    The row is picked before the city is looked at, so an account whose first row has
    no usable city is dropped even if another of its rows has one.
    """
    one_each = keep_first(bronze.filter(F.col("customer_id").isNotNull()), "customer_id")
    cleaned = one_each.withColumn("customer_city", clean_city("customer_city"))
    return cleaned.filter(F.col("customer_city") != "")


def orders(bronze: DataFrame) -> DataFrame:
    """One row per order among the rows whose stages are in order."""
    typed = _with_timestamps(bronze, *ORDER_STAGES, ESTIMATE)
    plausible = typed.filter(non_decreasing(*ORDER_STAGES) & F.col("order_id").isNotNull())
    return keep_first(plausible, "order_id")


def products(bronze: DataFrame, translation: DataFrame) -> DataFrame:
    """One row per product with no negative measure, category in English where known.

    As with customers the row is picked first; a product is dropped when the picked
    row has a negative measure. A null product id is kept as one row.
    """
    respelled = bronze.withColumnsRenamed(RESPELLED)
    typed = respelled.withColumns({name: int_or_null(name) for name in PRODUCT_COUNTS})
    one_each = keep_first(typed, "product_id")
    valid = one_each.filter(non_negative_or_null(*PRODUCT_COUNTS, *PRODUCT_SIZES))
    return translate_or_keep(
        valid, translation, "product_category_name", "product_category_name_english"
    )


def sellers(bronze: DataFrame) -> DataFrame:
    """One row per seller; unlike customers, an empty city is kept."""
    return keep_first(bronze, "seller_id").withColumn("seller_city", clean_city("seller_city"))


def order_items(bronze: DataFrame) -> DataFrame:
    typed = _with_timestamps(bronze, "shipping_limit_date")
    return typed.filter(non_negative("price", "freight_value"))


def order_reviews(bronze: DataFrame) -> DataFrame:
    typed = _with_timestamps(bronze, "review_creation_date", "review_answer_timestamp")
    return typed.filter(within("review_score", 1, 5))


def order_payments(bronze: DataFrame) -> DataFrame:
    return bronze.distinct()


def geolocation(bronze: DataFrame) -> DataFrame:
    """Mean position per zip prefix, with its smallest (city, state) pair.

    City and state come from the same row. Points outside the globe are left out
    first; a zip whose picked city cleans to nothing is dropped.
    """
    on_globe = bronze.filter(
        within("geolocation_lat", -90, 90) & within("geolocation_lng", -180, 180)
    )
    place = F.struct("geolocation_city", "geolocation_state")
    per_zip = on_globe.groupBy("geolocation_zip_code_prefix").agg(
        F.avg("geolocation_lat").alias("geo_lat"),
        F.avg("geolocation_lng").alias("geo_lng"),
        F.min(place).alias("place"),
    )
    cleaned = per_zip.select(
        "geolocation_zip_code_prefix",
        "geo_lat",
        "geo_lng",
        clean_city("place.geolocation_city").alias("geolocation_city"),
        F.col("place.geolocation_state").alias("geolocation_state"),
    )
    return cleaned.filter(F.col("geolocation_city") != "")


# --- audit ------------------------------------------------------------------------


def dropped_customers(bronze: DataFrame) -> DataFrame:
    return dropped_by_rule(
        bronze,
        {"no_key": F.col("customer_id").isNotNull()},
        ["customer_id"],
        later_rules={"empty_city": clean_city("customer_city") != ""},
    )


def dropped_orders(bronze: DataFrame) -> DataFrame:
    typed = _with_timestamps(bronze, *ORDER_STAGES, ESTIMATE)
    rules = {"stages_out_of_order": non_decreasing(*ORDER_STAGES), "no_key": F.col("order_id").isNotNull()}
    return dropped_by_rule(typed, rules, ["order_id"])


def dropped_products(bronze: DataFrame) -> DataFrame:
    respelled = bronze.withColumnsRenamed(RESPELLED)
    typed = respelled.withColumns({name: int_or_null(name) for name in PRODUCT_COUNTS})
    valid = non_negative_or_null(*PRODUCT_COUNTS, *PRODUCT_SIZES)
    return dropped_by_rule(typed, {}, ["product_id"], later_rules={"negative_measure": valid})


def dropped_sellers(bronze: DataFrame) -> DataFrame:
    return dropped_by_rule(bronze, {}, ["seller_id"])


def dropped_order_items(bronze: DataFrame) -> DataFrame:
    return dropped_by_rule(bronze, {"negative_amount": non_negative("price", "freight_value")})


def dropped_order_reviews(bronze: DataFrame) -> DataFrame:
    return dropped_by_rule(bronze, {"score_out_of_range": within("review_score", 1, 5)})


def dropped_order_payments(bronze: DataFrame) -> DataFrame:
    return dropped_by_rule(bronze, {}, bronze.columns)


def dropped_geolocation(bronze: DataFrame) -> DataFrame:
    """Points that share a zip prefix become one row: all but one of them count as copies."""
    on_globe = within("geolocation_lat", -90, 90) & within("geolocation_lng", -180, 180)
    return dropped_by_rule(
        bronze,
        {"off_the_globe": on_globe},
        ["geolocation_zip_code_prefix"],
        ["geolocation_city", "geolocation_state"],
        {"empty_city": clean_city("geolocation_city") != ""},
    )


DROPPED = {
    "customers": dropped_customers,
    "orders": dropped_orders,
    "products": dropped_products,
    "sellers": dropped_sellers,
    "order_items": dropped_order_items,
    "order_reviews": dropped_order_reviews,
    "order_payments": dropped_order_payments,
    "geolocation": dropped_geolocation,
}
