"""Silver to gold: four dimensions and three facts.

How the facts are joined
------------------------
The customer key depends on the order alone, so it is resolved once per order
(``order_header``) and the item-level table, the largest one, is never shuffled by
customer. Payments are summed per order before they meet the header.

Every join whose left side may hold a hot key (one order, customer, product or seller
with a large share of the rows) reads both sides from a shuffle and is followed by a
shuffle on something else. That is the shape in which adaptive execution can split a
skewed partition into several tasks, whatever made it skewed: a hot key, null keys or
many copies of one row. No dimension is broadcast by hint, since they grow with the
data; Spark broadcasts those it measures to be small.

A surrogate key is a function of the natural key alone, so a join with a dimension only
has to tell whether the key is there. The joins carry natural keys and a flag; hashes of
64 characters are made last, once per row of the result, and are never shuffled.
"""

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.functions import date_key, haversine_km, key_text, known_key
from feira.operators import distinct_rows, keep_first
from feira.sources import calendar

SUNDAY, SATURDAY = 1, 7
CUSTOMER_POSITION = ["customer_lat", "customer_lng"]
SELLER_POSITION = ["seller_lat", "seller_lng"]


# --- dimensions -------------------------------------------------------------------


def _dimension(silver: DataFrame, key: str, natural_key: str, *attributes: str) -> DataFrame:
    """One row per natural key, under a hashed key.

    Rows are grouped by the text that is hashed, not by the hash: the groups are the
    same, the shuffled key is shorter, and each hash is computed once. A null natural
    key shares its group, and its hash, with the empty one.
    """
    text = key_text(natural_key).alias("_key_text")
    one_each = keep_first(silver.select(text, natural_key, *attributes), "_key_text")
    return one_each.select(F.sha2("_key_text", 256).alias(key), natural_key, *attributes)


def dim_customers(customers: DataFrame) -> DataFrame:
    return _dimension(
        customers,
        "customer_key",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    )


def dim_products(products: DataFrame) -> DataFrame:
    return _dimension(
        products.withColumnRenamed("product_category_name", "category_name_english"),
        "product_key",
        "product_id",
        "category_name_english",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return _dimension(
        sellers,
        "seller_key",
        "seller_id",
        "seller_zip_code_prefix",
        "seller_city",
        "seller_state",
    )


def date_attributes(days: DataFrame) -> DataFrame:
    """The date dimension for a DataFrame of days in ``full_date``."""
    day = F.col("full_date")
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.dayofweek(day).isin(SUNDAY, SATURDAY).alias("is_weekend"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.lit(False).alias("is_holiday"),
    )


def dim_date(
    spark: SparkSession, first: date = calendar.FIRST_DAY, last: date = calendar.LAST_DAY
) -> DataFrame:
    return date_attributes(calendar.days_between(spark, first, last))


# --- shared by the facts ----------------------------------------------------------


def payments_per_order(payments: DataFrame) -> DataFrame:
    """Paid total, longest instalment plan, and whether any payment was a voucher."""
    voucher = F.when(F.col("payment_type") == "voucher", 1).otherwise(0)
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("payment_value"),
        F.max("payment_installments").alias("payment_installments"),
        F.max(voucher).alias("is_voucher"),
    )


def _known(
    dimension: DataFrame, natural_key: str, role: str, geolocation: DataFrame | None = None
) -> DataFrame:
    """The dimension's keys with a flag and, if places are given, where each one is."""
    flag = F.lit(True).alias(f"{role}_known")
    if geolocation is None:
        return dimension.select(natural_key, flag)
    prefix = f"{role}_zip_code_prefix"
    places = geolocation.select(
        F.col("geolocation_zip_code_prefix").alias(prefix),
        F.col("geo_lat").alias(f"{role}_lat"),
        F.col("geo_lng").alias(f"{role}_lng"),
    )
    return dimension.select(natural_key, prefix, flag).join(places, prefix, "left").drop(prefix)


def order_header(
    orders: DataFrame,
    customers: DataFrame,
    dim_customers: DataFrame,
    order_payments: DataFrame | None = None,
    geolocation: DataFrame | None = None,
) -> DataFrame:
    """Per order: its times, the person who ordered and, if given, what was paid and the
    person's position.

    Both hops of the customer lookup (account, then person) happen here. Payments are
    joined first and the customer last, so that the result leaves a join on customers
    and is shuffled to the items on its own (see the note at the top).
    """
    header = orders.select(
        "order_id",
        "customer_id",
        "order_purchase_timestamp",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    if order_payments is not None:
        header = header.join(payments_per_order(order_payments), "order_id", "left")
    persons = _known(dim_customers, "customer_unique_id", "customer", geolocation)
    accounts = customers.select("customer_id", "customer_unique_id").join(
        persons, "customer_unique_id", "left"
    )
    person = F.when(F.col("customer_known"), F.col("customer_unique_id")).alias("person")
    position = [name for name in CUSTOMER_POSITION if name in persons.columns]
    known = accounts.select("customer_id", person, *position)
    return header.join(known, "customer_id", "left").drop("customer_id")


def order_lines(
    order_items: DataFrame,
    header: DataFrame,
    dim_products: DataFrame,
    dim_sellers: DataFrame,
    geolocation: DataFrame | None = None,
) -> DataFrame:
    """Items of known orders with the header, and whether product and seller are known;
    with places given, also the seller's position.

    All three facts start from this; a run that builds them all stores it once
    (``feira.plans.layers``).
    """
    sold = order_items.drop("shipping_limit_date").join(header, "order_id")
    return known_lines(sold, dim_products, dim_sellers, geolocation)


def known_lines(
    sold: DataFrame,
    dim_products: DataFrame,
    dim_sellers: DataFrame,
    geolocation: DataFrame | None = None,
) -> DataFrame:
    """Items that already have their order's header, with what is known of product and seller."""
    return (
        sold.join(_known(dim_products, "product_id", "product"), "product_id", "left")
        .join(_known(dim_sellers, "seller_id", "seller", geolocation), "seller_id", "left")
    )


# --- facts ------------------------------------------------------------------------
#
# Each fact is made in two steps: distinct rows of natural keys, then their hashes. The
# hash tells the same rows apart as the text it is made from.


def _natural_keys() -> list[Column]:
    return [
        F.col("person"),
        F.when(F.col("product_known"), F.col("product_id")).alias("product"),
        F.when(F.col("seller_known"), F.col("seller_id")).alias("seller"),
    ]


def _hashed_keys() -> list[Column]:
    return [
        known_key("person").alias("customer_key"),
        known_key("product").alias("product_key"),
        known_key("seller").alias("seller_key"),
    ]


def fact_sales(lines: DataFrame, with_voucher: bool = False) -> DataFrame:
    """One row per sold item; the order's paid total is repeated on each of its items."""
    measures = ["date_key", "price", "freight_value", "payment_value", "payment_installments"]
    if with_voucher:
        measures.append("is_voucher")
    sold = lines.withColumn("date_key", date_key("order_purchase_timestamp")).select(
        key_text("order_id", "order_item_id").alias("sale"), *_natural_keys(), *measures
    )
    return sold.distinct().select(
        F.sha2("sale", 256).alias("sale_key"),
        *_hashed_keys(),
        *measures,
    )


def fact_shipping(lines: DataFrame, by_day: bool = False) -> DataFrame:
    """Delivered items: days to deliver, days after the estimate, late or not.

    Days are calendar days, while ``is_late`` compares the full times, so a parcel can
    be late with an error of 0 days.

    ``by_day`` orders the rows by day across and within files, so that readers can skip
    files by date. The shipment is part of that order, which spreads a busy day over
    several tasks.

    Lines that carry the positions of customer and seller also give the distance between
    them in km, null where one is not known. It is made beside the shipment, so nothing
    is shuffled for it.
    """
    purchased = F.col("order_purchase_timestamp")
    delivered = F.col("order_delivered_customer_date")
    estimated = F.col("order_estimated_delivery_date")
    measures = ["date_key", "delivery_lead_time", "estimated_delivery_error", "is_late"]
    distance = []
    if {*CUSTOMER_POSITION, *SELLER_POSITION} <= set(lines.columns):
        measures.insert(3, "shipping_distance_km")
        km = haversine_km(*CUSTOMER_POSITION, *SELLER_POSITION)
        distance.append(km.alias("shipping_distance_km"))
    shipped = (
        lines.select(
            key_text("order_id", "order_item_id", "seller_id").alias("shipment"),
            *_natural_keys(),
            date_key(purchased).alias("date_key"),
            F.datediff(delivered, purchased).alias("delivery_lead_time"),
            F.datediff(delivered, estimated).alias("estimated_delivery_error"),
            *distance,
            F.coalesce(delivered > estimated, F.lit(False)).alias("is_late"),
        )
        .filter(F.col("delivery_lead_time").isNotNull())
        .distinct()
    )
    if by_day:
        order = ["date_key", "shipment"]
        shipped = shipped.repartitionByRange(*order).sortWithinPartitions(*order)
    return shipped.select(
        F.sha2("shipment", 256).alias("shipping_key"),
        *_hashed_keys(),
        *measures,
    )


def fact_reviews(order_reviews: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per review and per distinct (product, seller) of the reviewed order.

    Copies are removed on both sides before they can multiply. An order's lines are
    reduced, and the result too, with ``distinct_rows``: a plain ``distinct`` would
    settle for the partitioning by order that the joins leave, and a hot order could
    then not be split.
    """
    sold = distinct_rows(lines.select("order_id", "product_id", "seller_id", "person"))
    comment = F.coalesce("review_comment_message", F.lit(""))
    measures = ["date_key", "order_id", "review_score", "comment_length", "response_time"]
    reviewed = order_reviews.select(
        "review_id",
        "order_id",
        date_key("review_creation_date").alias("date_key"),
        F.col("review_score").cast("int").alias("review_score"),
        F.length(comment).alias("comment_length"),
        F.col("review_answer_timestamp").cast("timestamp").alias("response_time"),
    ).distinct()
    pairs = reviewed.join(sold, "order_id").select(
        key_text("review_id", "product_id", "seller_id").alias("review"), "person", *measures
    )
    return distinct_rows(pairs).select(
        F.sha2("review", 256).alias("review_key"),
        known_key("person").alias("customer_key"),
        *measures,
    )


# --- further measures -------------------------------------------------------------


def review_response_days(order_reviews: DataFrame) -> DataFrame:
    """Whole days between the creation of a review and its answer."""
    days = F.datediff("review_answer_timestamp", "review_creation_date")
    return order_reviews.select("review_id", "order_id", days.alias("response_days"))

