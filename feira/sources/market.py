"""Bronze-shaped tables made from a generic sales schema (customer, orders, lineitem, ...).

Maps the tables this repository is tested with onto the eight exported entities, so
that every transform can run on them at any scale. The mapping also brings in the dirt
the transforms are there to remove: null and digit-only cities, missing stages, negative
measures, scores out of range and points off the globe; and rows that repeat a key. Of
these some sort before the right row and fail a later rule, some sort after it, some have
no key at all, and items, payments and reviews come as exact copies too.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _copy_numbers(conditions: list[tuple[int, Column]], chosen: tuple[int, ...] = (0,)) -> Column:
    """0 and the number of each condition that is met, as one constant array per combination.

    Building and filtering an array for each row took about half the time of reading the items.
    """
    if not conditions:
        return F.array(*[F.lit(k) for k in chosen])
    (k, condition), *rest = conditions
    met, unmet = _copy_numbers(rest, (*chosen, k)), _copy_numbers(rest, chosen)
    return F.when(condition, met).otherwise(unmet)


def _with_copies(df: DataFrame, *copies: tuple[Column, dict[str, Column]]) -> DataFrame:
    """Every row, and for each (condition, changes) that it meets a changed copy of it.

    Rows are multiplied by a short array of the copies' numbers. Which copy a row is decides
    each column on its own, so columns that are not asked for are never read.
    """
    every = _copy_numbers([(k, condition) for k, (condition, _) in enumerate(copies, 1)])
    dealt = df.select("*", F.explode(every).alias("_copy"))
    columns = []
    for field in df.schema:
        value = F.col(field.name)
        for k, (_, changes) in enumerate(copies, 1):
            if field.name in changes:
                changed = changes[field.name].cast(field.dataType)
                value = F.when(F.col("_copy") == k, changed).otherwise(value)
        columns.append(value.alias(field.name))
    return dealt.select(*columns)


def _number(key: str, divisor: int, rest: int) -> Column:
    return F.col(key).cast("long") % divisor == rest


class Market:
    """Reads ``<folder>/<table>.parquet`` and offers the bronze entities as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._opened: dict[str, DataFrame] = {}

    def read(self, table: str) -> DataFrame:
        """Opened once: finding out a schema is a Spark job of its own."""
        if table not in self._opened:
            self._opened[table] = self.spark.read.parquet(f"{self.folder}/{table}.parquet")
        return self._opened[table]

    def customers(self) -> DataFrame:
        """Two accounts per person."""
        key = F.col("c_custkey")
        city = (
            F.when(key % 97 == 0, F.lit(None).cast("string"))
            .when(key % 89 == 0, F.lit(" 12 "))
            .otherwise(F.concat(F.lit("São "), "c_mktsegment", F.lit(" "), "n_name"))
        )
        nation = self.read("nation")
        base = (
            self.read("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                key.cast("string").alias("customer_id"),
                F.expr("c_custkey div 2").cast("string").alias("customer_unique_id"),
                F.col("c_nationkey").alias("customer_zip_code_prefix"),
                city.alias("customer_city"),
                F.col("n_name").alias("customer_state"),
            )
        )
        return _with_copies(
            base,
            # sorts first and has no city: the account goes with it
            (
                _number("customer_id", 11, 3),
                {"customer_zip_code_prefix": F.lit(-1), "customer_city": F.lit("12")},
            ),
            (
                _number("customer_id", 13, 4),
                {"customer_zip_code_prefix": F.col("customer_zip_code_prefix") + 1000},
            ),
            (_number("customer_id", 17, 5), {"customer_id": F.lit(None)}),
        )

    def orders(self) -> DataFrame:
        shipped = (
            self.read("lineitem")
            .groupBy("l_orderkey")
            .agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
        )
        purchase = F.col("o_orderdate").cast("timestamp")
        status = F.col("o_orderstatus")
        base = (
            self.read("orders")
            .join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .select(
                F.col("o_orderkey").cast("string").alias("order_id"),
                F.col("o_custkey").cast("string").alias("customer_id"),
                status.alias("order_status"),
                purchase.alias("order_purchase_timestamp"),
                F.when(status != "P", purchase + F.expr("interval 1 day")).alias(
                    "order_approved_at"
                ),
                F.col("first_ship").cast("timestamp").alias("order_delivered_carrier_date"),
                F.when(status != "O", F.col("last_ship").cast("timestamp")).alias(
                    "order_delivered_customer_date"
                ),
                (purchase + F.expr("interval 60 days")).alias("order_estimated_delivery_date"),
            )
        )
        return _with_copies(
            base,
            # sorts first, but its stages are out of order, so it is not among the rows to pick
            (
                _number("order_id", 11, 3),
                {
                    "customer_id": F.lit("0"),
                    "order_approved_at": F.col("order_purchase_timestamp")
                    - F.expr("interval 1 day"),
                },
            ),
            (
                _number("order_id", 13, 4),
                {"customer_id": F.concat("customer_id", F.lit("9"))},
            ),
            (_number("order_id", 17, 5), {"order_id": F.lit(None)}),
        )

    def order_items(self) -> DataFrame:
        """Freight is the tax in percent less one, so untaxed lines have negative freight."""
        freight = F.col("l_tax").cast("decimal(4,2)") * 100 - 1
        base = self.read("lineitem").select(
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_suppkey").cast("string").alias("seller_id"),
            F.col("l_shipdate").cast("timestamp").alias("shipping_limit_date"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
            freight.cast("decimal(18,2)").alias("freight_value"),
        )
        return _with_copies(
            base,
            (_number("order_id", 7, 2), {}),
        )

    def order_payments(self) -> DataFrame:
        """The discounted price. Both operands are made decimal, so the product is exact;
        with at most 18 digits in all it is also held in a long."""
        kind = F.when(F.col("l_returnflag") == "R", "voucher").when(
            F.col("l_returnflag") == "A", "credit_card"
        )
        price = F.col("l_extendedprice").cast("decimal(12,2)")
        base = self.read("lineitem").select(
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("l_linenumber").alias("payment_sequential"),
            kind.alias("payment_type"),
            (F.col("l_quantity").cast("int") % 12).alias("payment_installments"),
            (price * (1 - F.col("l_discount").cast("decimal(4,2)"))).alias("payment_value"),
        )
        return _with_copies(
            base,
            (_number("order_id", 7, 3), {}),
        )

    def products(self) -> DataFrame:
        key, size = F.col("p_partkey"), F.col("p_size").cast("double")
        base = self.read("part").select(
            key.cast("string").alias("product_id"),
            F.when(key % 41 != 0, F.col("p_type")).alias("product_category_name"),
            (F.length("p_name") + 0.5).cast("double").alias("product_name_lenght"),
            (size * 10).alias("product_description_lenght"),
            (size % 6).alias("product_photos_qty"),
            F.when(key % 50 != 0, size - 5).alias("product_weight_g"),
            (size * 1.5).alias("product_length_cm"),
            (size / 2).alias("product_height_cm"),
            (size + 0.25).alias("product_width_cm"),
        )
        return _with_copies(
            base,
            # sorts before every named category and has a negative weight
            (
                _number("product_id", 11, 3),
                {"product_category_name": F.lit("A"), "product_weight_g": F.lit(-1.0)},
            ),
            (_number("product_id", 13, 4), {"product_category_name": F.lit("zzz")}),
            (_number("product_id", 17, 5), {"product_id": F.lit(None)}),
        )

    def translation(self) -> DataFrame:
        """Every category but one, so that one has to fall back to its own name."""
        categories = self.read("part").select("p_type").distinct()
        return categories.filter(F.col("p_type") != "STANDARD").select(
            F.col("p_type").alias("product_category_name"),
            F.concat(F.lit("english "), F.lower("p_type")).alias("product_category_name_english"),
        )

    def sellers(self) -> DataFrame:
        nation = self.read("nation")
        base = (
            self.read("supplier")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").cast("string").alias("seller_id"),
                F.col("s_nationkey").alias("seller_zip_code_prefix"),
                F.concat(F.lit("Córdoba "), F.col("s_suppkey").cast("string")).alias("seller_city"),
                F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("seller_state"),
            )
        )
        return _with_copies(
            base,
            (
                _number("seller_id", 11, 3),
                {"seller_zip_code_prefix": F.lit(-1), "seller_city": F.lit("12")},
            ),
            (
                _number("seller_id", 13, 4),
                {"seller_zip_code_prefix": F.col("seller_zip_code_prefix") + 1000},
            ),
            (_number("seller_id", 17, 5), {"seller_id": F.lit(None)}),
        )

    def order_reviews(self) -> DataFrame:
        """Two reviews per order; scores 0 and 6 are out of range."""
        event, created = F.col("event_id"), F.col("ts").cast("timestamp")
        base = self.read("events").select(
            event.cast("string").alias("review_id"),
            F.expr("event_id div 2").cast("string").alias("order_id"),
            (event % 7).cast("int").alias("review_score"),
            F.lit(None).cast("string").alias("review_comment_title"),
            F.when(F.col("event_type") != "error", F.col("props")).alias("review_comment_message"),
            created.alias("review_creation_date"),
            (created + F.make_dt_interval((event % 10).cast("int"))).alias(
                "review_answer_timestamp"
            ),
        )
        return _with_copies(
            base,
            (_number("review_id", 7, 1), {}),
        )

    def geolocation(self) -> DataFrame:
        """Ten zip prefixes, some points off the globe, one prefix with no city name."""
        point = F.col("embedding")
        city = F.when(F.col("label") == 9, F.lit("99")).otherwise(
            F.concat(F.lit("São Cidade "), (F.col("vec_id") % 5).cast("string"))
        )
        return self.read("embeddings").select(
            F.col("label").alias("geolocation_zip_code_prefix"),
            (point[0].cast("double") * 300).alias("geolocation_lat"),
            (point[1].cast("double") * 600).alias("geolocation_lng"),
            city.alias("geolocation_city"),
            F.concat(F.lit("S"), (F.col("vec_id") % 3).cast("string")).alias("geolocation_state"),
        )
