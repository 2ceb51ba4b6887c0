"""Every operator and table transform as a query over the test tables.

Each query reads whole tables through ``Market``. On the way out decimals become
doubles and dates and times become zone-less timestamps, so that results compare by
value with those of another engine.
"""

from collections.abc import Callable
from datetime import date
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.functions import (
    clean_city,
    int_or_null,
    non_decreasing,
    non_negative_or_null,
    surrogate_key,
    timestamp_or_null,
)
from feira.operators import assign_nearest, keep_first, orphans, row_audit, rule_audit
from feira.plans import gold, segments, silver
from feira.sources import calendar
from feira.sources.market import Market
from feira.sources.working import new_folder, store

Query = Callable[[SparkSession, str], DataFrame]

# The test orders lie outside the default calendar.
FIRST_DAY, LAST_DAY = date(1995, 1, 1), date(2001, 12, 31)

# Centres for the fixed assignment, on the standardised (recency, frequency, monetary) scale.
CENTRES = [(1.5, -0.5, -0.5), (-0.5, -0.5, -0.5), (-0.5, 0.5, 0.5), (-0.5, 2.0, 2.0)]


def _once(build):
    """A frame that several others start from is built, and analysed, once."""

    @wraps(build)
    def get(self):
        if build.__name__ not in self.made:
            self.made[build.__name__] = build(self)
        return self.made[build.__name__]

    return get


class _Tables:
    """Silver and gold frames over one folder of test tables, built on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.raw = Market(spark, folder)
        self.spark = spark
        self.made: dict[str, DataFrame] = {}

    @_once
    def customers(self):
        return silver.customers(self.raw.customers())

    @_once
    def orders(self):
        return silver.orders(self.raw.orders())

    @_once
    def products(self):
        return silver.products(self.raw.products(), self.raw.translation())

    @_once
    def sellers(self):
        return silver.sellers(self.raw.sellers())

    @_once
    def order_items(self):
        return silver.order_items(self.raw.order_items())

    @_once
    def order_reviews(self):
        return silver.order_reviews(self.raw.order_reviews())

    @_once
    def order_payments(self):
        return silver.order_payments(self.raw.order_payments())

    @_once
    def geolocation(self):
        return silver.geolocation(self.raw.geolocation())

    @_once
    def dim_customers(self):
        return gold.dim_customers(self.customers())

    @_once
    def dim_products(self):
        return gold.dim_products(self.products())

    @_once
    def dim_sellers(self):
        return gold.dim_sellers(self.sellers())

    def lines(self, paid: bool = False, placed: bool = False):
        payments = self.order_payments() if paid else None
        places = self.geolocation() if placed else None
        header = gold.order_header(
            self.orders(), self.customers(), self.dim_customers(), payments, places
        )
        return gold.order_lines(
            self.order_items(), header, self.dim_products(), self.dim_sellers(), places
        )

    def rfm_totals(self):
        """Stored, one row per person: what follows reads it more than once, as a run does."""
        totals = segments.rfm_totals(
            gold.fact_sales(self.lines(paid=True)),
            gold.dim_date(self.spark, FIRST_DAY, LAST_DAY),
            self.dim_customers(),
        )
        return store(totals, "rfm_totals", new_folder(self.spark))

    def rfm(self):
        return segments.rfm_features(self.rfm_totals())


def filter_chronology(t: _Tables) -> DataFrame:
    """F3 and P5: which orders have their stages in order."""
    kept = F.coalesce(non_decreasing(*silver.ORDER_STAGES), F.lit(False))
    return t.raw.orders().select("order_id", kept.alias("kept"))


def filter_measures(t: _Tables) -> DataFrame:
    """F4 before any de-duplication: which products have no negative measure."""
    typed = t.raw.products().withColumnsRenamed(silver.RESPELLED)
    valid = non_negative_or_null(*silver.PRODUCT_COUNTS, *silver.PRODUCT_SIZES)
    return typed.select("product_id", valid.alias("kept"))


def cast_text_dates(t: _Tables) -> DataFrame:
    """P5 on text, with text that is empty or no date."""
    written = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    text = (
        F.when(F.col("o_orderstatus") == "F", written)
        .when(F.col("o_orderstatus") == "O", "")
        .otherwise("soon")
    )
    as_text = t.raw.read("orders").select("o_orderkey", text.alias("placed"))
    return as_text.select("o_orderkey", "placed", timestamp_or_null("placed").alias("placed_at"))


def cast_text_ints(t: _Tables) -> DataFrame:
    """P6 on text such as 12.7, which truncates, and on text that is no number."""
    size = F.when(F.col("p_partkey") % 7 == 0, F.col("p_name")).otherwise(
        F.concat(F.lit("-"), F.col("p_size").cast("string"), F.lit(".7"))
    )
    as_text = t.raw.read("part").select("p_partkey", size.alias("size_text"))
    return as_text.select("p_partkey", "size_text", int_or_null("size_text").alias("size"))


def clean_text(t: _Tables) -> DataFrame:
    """E1 to E5 over whole documents."""
    return t.raw.read("documents").select("doc_id", clean_city("text").alias("cleaned"))


def surrogate_keys(t: _Tables) -> DataFrame:
    """E7 and E8 with a number and null parts."""
    kind = F.when(F.col("p_partkey") % 41 != 0, F.col("p_type"))
    return t.raw.read("part").select(
        "p_partkey",
        surrogate_key("p_brand", kind, "p_size").alias("wide_key"),
        surrogate_key(kind).alias("kind_key"),
    )


def _lineitem_rows(t: _Tables) -> DataFrame:
    return t.raw.read("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate"
    )


def dedup_by_key(t: _Tables) -> DataFrame:
    """D1: one line per order."""
    return keep_first(_lineitem_rows(t), "l_orderkey")


def dedup_then_filter(t: _Tables) -> DataFrame:
    """D4: the filter sees only the rows that were picked."""
    return keep_first(_lineitem_rows(t), "l_orderkey").filter(F.col("l_returnflag") == "R")


def distinct_lines(t: _Tables) -> DataFrame:
    """D3 on columns that do repeat."""
    return t.raw.read("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag").distinct()


def dim_date(t: _Tables) -> DataFrame:
    """S5 and C14 for the days that the orders span."""
    return gold.date_attributes(calendar.days_spanned(t.raw.read("orders"), "o_orderdate"))


def shipping_distance(t: _Tables) -> DataFrame:
    far = gold.fact_shipping(t.lines(placed=True))
    return far.withColumn("shipping_distance_km", F.round("shipping_distance_km", 4))


def silver_geolocation(t: _Tables) -> DataFrame:
    return t.geolocation().withColumns(
        {"geo_lat": F.round("geo_lat", 6), "geo_lng": F.round("geo_lng", 6)}
    )


def rfm_scaled(t: _Tables) -> DataFrame:
    scaled = segments.rfm_scaled(t.rfm_totals())
    return scaled.withColumns({f"{name}_z": F.round(f"{name}_z", 6) for name in segments.FEATURES})


def rfm_assign_fixed(t: _Tables) -> DataFrame:
    scaled = segments.rfm_scaled(t.rfm_totals())
    columns = [f"{name}_z" for name in segments.FEATURES]
    return assign_nearest(scaled, columns, CENTRES).select(*segments.PERSON, "Cluster")


def audit_counts(t: _Tables) -> DataFrame:
    return row_audit(
        {
            "customers": (t.raw.customers(), t.customers()),
            "orders": (t.raw.orders(), t.orders()),
            "products": (t.raw.products(), t.products()),
            "sellers": (t.raw.sellers(), t.sellers()),
            "order_items": (t.raw.order_items(), t.order_items()),
            "order_reviews": (t.raw.order_reviews(), t.order_reviews()),
            "order_payments": (t.raw.order_payments(), t.order_payments()),
            "geolocation": (t.raw.geolocation(), t.geolocation()),
        }
    )


def orphan_audit(t: _Tables) -> DataFrame:
    return orphans(
        [
            ("orders", t.orders(), "customers", t.customers(), "customer_id"),
            ("order_items", t.order_items(), "orders", t.orders(), "order_id"),
            ("order_items", t.order_items(), "products", t.products(), "product_id"),
            ("order_items", t.order_items(), "sellers", t.sellers(), "seller_id"),
            ("order_payments", t.order_payments(), "orders", t.orders(), "order_id"),
            ("order_reviews", t.order_reviews(), "orders", t.orders(), "order_id"),
        ]
    )


def audit_rules(t: _Tables) -> DataFrame:
    """A6 by reason: which rule drops how many rows of each table."""
    return rule_audit({name: count(getattr(t.raw, name)()) for name, count in silver.DROPPED.items()})


_BUILDERS: dict[str, Callable[[_Tables], DataFrame]] = {
    "silver_customers": _Tables.customers,
    "silver_orders": _Tables.orders,
    "silver_products": _Tables.products,
    "silver_sellers": _Tables.sellers,
    "silver_order_items": _Tables.order_items,
    "silver_order_reviews": _Tables.order_reviews,
    "silver_payments": _Tables.order_payments,
    "silver_geolocation": silver_geolocation,
    "filter_chronology": filter_chronology,
    "filter_measures": filter_measures,
    "cast_text_dates": cast_text_dates,
    "cast_text_ints": cast_text_ints,
    "clean_text": clean_text,
    "surrogate_keys": surrogate_keys,
    "dedup_by_key": dedup_by_key,
    "dedup_then_filter": dedup_then_filter,
    "distinct_lines": distinct_lines,
    "dim_customers": _Tables.dim_customers,
    "dim_products": _Tables.dim_products,
    "dim_sellers": _Tables.dim_sellers,
    "dim_date": dim_date,
    "payments_per_order": lambda t: gold.payments_per_order(t.order_payments()),
    "fact_sales": lambda t: gold.fact_sales(t.lines(paid=True)),
    "sales_with_voucher": lambda t: gold.fact_sales(t.lines(paid=True), with_voucher=True),
    "fact_reviews": lambda t: gold.fact_reviews(t.order_reviews(), t.lines()),
    "fact_shipping": lambda t: gold.fact_shipping(t.lines(), by_day=True),
    "shipping_distance": shipping_distance,
    "review_response_days": lambda t: gold.review_response_days(t.order_reviews()),
    "rfm_features": _Tables.rfm,
    "rfm_scaled": rfm_scaled,
    "rfm_assign_fixed": rfm_assign_fixed,
    "rfm_segments": lambda t: segments.checked_segments(t.rfm(), new_folder(t.spark)),
    "audit_counts": audit_counts,
    "orphan_audit": orphan_audit,
    "audit_rules": audit_rules,
}


def _comparable(df: DataFrame) -> DataFrame:
    def plain(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.DateType)):
            return F.col(field.name).cast("timestamp_ntz").alias(field.name)
        return F.col(field.name)

    return df.select(*[plain(field) for field in df.schema.fields])


def _query(build: Callable[[_Tables], DataFrame]) -> Query:
    return lambda spark, folder: _comparable(build(_Tables(spark, folder)))


def queries() -> dict[str, Query]:
    return {name: _query(build) for name, build in _BUILDERS.items()}
