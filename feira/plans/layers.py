"""Runs over a whole lake: read one layer, write the next."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira import schemas
from feira.operators import along_curve, orphans, row_audit, rule_audit
from feira.plans import gold, manifest, segments, silver
from feira.sources import calendar, contract, versions
from feira.sources.sinks import SESSION_CATALOG, export_csv, write_table
from feira.sources.versions import Buckets
from feira.sources.working import store, working_folder

# (child, parent, key) pairs that should match within silver.
LINKS = [
    ("orders", "customers", "customer_id"),
    ("order_items", "orders", "order_id"),
    ("order_items", "products", "product_id"),
    ("order_items", "sellers", "seller_id"),
    ("order_payments", "orders", "order_id"),
    ("order_reviews", "orders", "order_id"),
]


# Tables that meet by order, and so are stored in buckets by it if a lake has buckets.
BY_ORDER = {"orders", "order_items", "order_payments"}


@dataclass(frozen=True)
class Lake:
    """Where the layers are. Bronze is a folder per entity, the others catalog tables.

    With ``buckets``, silver tables that meet by order are stored in so many buckets by order:
    items are then joined with their orders where they lie, without a shuffle. ``resume``
    notes what each table was made from, and leaves tables as they are that were made from the
    same inputs by the same code before (``manifest``). ``strict`` refuses, before any row moves,
    to write a table whose columns could lose a value against those declared (``contract``).
    """

    spark: SparkSession
    bronze_root: str
    catalog: str = SESSION_CATALOG
    table_format: str = "parquet"
    properties: dict[str, str] = field(default_factory=dict)
    buckets: int = 0
    resume: bool = False
    strict: bool = False

    def __post_init__(self):
        zone = self.spark.conf.get("spark.sql.session.timeZone")
        if zone not in ("UTC", "Etc/UTC", "Z", "GMT"):
            raise ValueError(f"days are counted in UTC, but the session's time zone is {zone}")

    def bronze(self, entity: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.bronze_root}/{entity}")

    def name(self, layer: str, table: str) -> str:
        return f"{self.catalog}.{layer}.{table}"

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def buckets_of(self, layer: str, table: str) -> Buckets | None:
        by_order = layer == "silver" and table in BY_ORDER
        return Buckets(self.buckets, ("order_id",)) if self.buckets and by_order else None

    def write(self, df: DataFrame, layer: str, table: str) -> None:
        declared = contract.declared_columns(layer, table) if self.strict else None
        if declared:
            df = contract.conform(df, declared, self.name(layer, table))
        self.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {self.catalog}.{layer}")
        buckets = self.buckets_of(layer, table)
        if buckets:
            # each bucket is a file, or a few where adaptive execution splits a large one
            df = df.hint("rebalance", buckets.count, *buckets.columns)
        write_table(df, self.name(layer, table), self.table_format, self.properties, buckets)

    def made_from(self, inputs: Sequence[str], **options: object) -> str | None:
        """What a table is made from, as a digest: inputs are named ``layer.table``."""
        found = []
        for name in inputs:
            layer, table = name.split(".")
            if layer == "bronze":
                found.append(manifest.folder_state(self.spark, f"{self.bronze_root}/{table}"))
            else:
                found.append(manifest.table_state(self.spark, self.name(layer, table)))
        return manifest.digest(dict(zip(inputs, found, strict=True)), options)

    def is_current(self, layer: str, table: str, made_from: str | None) -> bool:
        return manifest.is_current(self.spark, self.name(layer, table), made_from)

    def make(
        self,
        layer: str,
        table: str,
        inputs: Sequence[str],
        build: Callable[[], DataFrame],
        **options: object,
    ) -> bool:
        """Write a table, unless it is to be resumed and current; returns whether it was written."""
        made_from = None
        if self.resume:
            options["buckets"] = self.buckets_of(layer, table)
            made_from = self.made_from(inputs, **options)
            if self.is_current(layer, table, made_from):
                return False
        self.write(build(), layer, table)
        if made_from:
            manifest.note(self.spark, self.name(layer, table), made_from)
        return True


SILVER: dict[str, Callable[[Lake], DataFrame]] = {
    "geolocation": lambda lake: silver.geolocation(lake.bronze("geolocation")),
    "products": lambda lake: silver.products(
        lake.bronze("products"), lake.bronze(schemas.TRANSLATION)
    ),
    "customers": lambda lake: silver.customers(lake.bronze("customers")),
    "sellers": lambda lake: silver.sellers(lake.bronze("sellers")),
    "orders": lambda lake: silver.orders(lake.bronze("orders")),
    "order_items": lambda lake: silver.order_items(lake.bronze("order_items")),
    "order_reviews": lambda lake: silver.order_reviews(lake.bronze("order_reviews")),
    "order_payments": lambda lake: silver.order_payments(lake.bronze("order_payments")),
}


def run_silver(lake: Lake) -> None:
    for table, build in SILVER.items():
        inputs = [f"bronze.{table}"]
        if table == "products":
            inputs.append(f"bronze.{schemas.TRANSLATION}")
        lake.make("silver", table, inputs, lambda build=build: build(lake))


def audit_silver(lake: Lake) -> DataFrame:
    """Rows in, kept and dropped for each silver table that has been written."""
    return row_audit({t: (lake.bronze(t), lake.table("silver", t)) for t in SILVER})


def audit_rules(lake: Lake) -> DataFrame:
    """Rows of bronze that each rule drops on the way to silver."""
    return rule_audit({table: count(lake.bronze(table)) for table, count in silver.DROPPED.items()})


def audit_links(lake: Lake) -> DataFrame:
    """Rows of silver tables that point at no row of the table they refer to."""
    return orphans(
        (child, lake.table("silver", child), parent, lake.table("silver", parent), key)
        for child, parent, key in LINKS
    )


def run_dimensions(
    lake: Lake, first_day: date = calendar.FIRST_DAY, last_day: date = calendar.LAST_DAY
) -> None:
    for table, build in [
        ("customers", gold.dim_customers),
        ("products", gold.dim_products),
        ("sellers", gold.dim_sellers),
    ]:
        made = lambda build=build, table=table: build(lake.table("silver", table))
        lake.make("gold", f"dim_{table}", [f"silver.{table}"], made)
    days = (first_day, last_day)
    lake.make("gold", "dim_date", [], lambda: gold.dim_date(lake.spark, *days), days=days)


# What sales are filtered by: the columns of the curve that they are laid along.
SALES_CURVE = ["date_key", "customer_key", "seller_key"]


def _laid_out(fact: DataFrame, by_day: bool) -> DataFrame:
    """In order of day across and within files if asked for, so that readers of some days
    skip files. The fact's own key takes part, which spreads a busy day."""
    if not by_day:
        return fact
    order = ["date_key", *[name for name in fact.columns if name.endswith("_key")][:1]]
    return fact.repartitionByRange(*order).sortWithinPartitions(*order)


def sold_items(lake: Lake, header: DataFrame) -> DataFrame:
    """Items with the header of their order.

    In a lake with buckets, items and header meet bucket by bucket, so items are not shuffled.
    A bucket is one task, though, which nothing can split. Orders with more items than an
    average bucket holds, of which there are fewer than buckets, are therefore left out there;
    their items are read without regard to buckets, in as many tasks as the files give, and
    their few headers are sent to all of these.
    """
    items = lake.table("silver", "order_items").drop("shipping_limit_date")
    entry = versions.entry(lake.spark, lake.name("silver", "order_items"))
    if not (lake.buckets and entry and entry.buckets):
        return items.join(header, "order_id")
    per_order = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    bucket = items.count() // entry.buckets.count + 1
    hot = per_order.where((F.col("n") > bucket) & F.col("order_id").isNotNull()).select("order_id")
    with_hot = not hot.isEmpty()
    if not with_hot:
        return items.join(header, "order_id")
    few = F.broadcast(hot)  # fewer rows than there are buckets
    cold = items.join(few, "order_id", "left_anti").join(header, "order_id")
    anywhere = lake.spark.read.format(entry.provider).load(entry.location).select(*items.columns)
    their_header = F.broadcast(header.join(few, "order_id", "left_semi"))
    return cold.unionByName(anywhere.join(their_header, "order_id"))


def run_facts(lake: Lake, by_day: bool = False, by_curve: bool = False) -> None:
    """The lines that all three facts start from are joined and stored once.

    Shipping is always in order of day; ``by_day`` writes sales and reviews so as well,
    for one more shuffle of each. ``by_curve`` lays sales along a curve through day, customer
    and seller instead, so that readers of some of any of these skip files.
    """
    shared = ["silver.orders", "silver.customers", "silver.order_payments", "silver.geolocation"]
    shared += ["silver.order_items", "gold.dim_customers", "gold.dim_products", "gold.dim_sellers"]
    inputs = {
        "fact_sales": shared,
        "fact_reviews": [*shared, "silver.order_reviews"],
        "fact_shipping": shared,
    }
    options = {"fact_sales": {"by_day": by_day, "by_curve": by_curve}, "fact_reviews": {"by_day": by_day}, "fact_shipping": {}}
    if lake.resume and all(
        lake.is_current("gold", fact, lake.made_from(names, buckets=None, **options[fact]))
        for fact, names in inputs.items()
    ):
        return
    header = gold.order_header(
        lake.table("silver", "orders"),
        lake.table("silver", "customers"),
        lake.table("gold", "dim_customers"),
        lake.table("silver", "order_payments"),
        lake.table("silver", "geolocation"),
    )
    joined = gold.known_lines(
        sold_items(lake, header),
        lake.table("gold", "dim_products"),
        lake.table("gold", "dim_sellers"),
        lake.table("silver", "geolocation"),
    )
    with working_folder(lake.spark) as folder:
        lines = store(joined, "order_lines", folder)

        def sales() -> DataFrame:
            sold = gold.fact_sales(lines, with_voucher=True)
            if by_curve:
                return along_curve(store(sold, "fact_sales", folder), *SALES_CURVE)
            return _laid_out(sold, by_day)

        builds = {
            "fact_sales": sales,
            "fact_reviews": lambda: _laid_out(
                gold.fact_reviews(lake.table("silver", "order_reviews"), lines), by_day
            ),
            "fact_shipping": lambda: gold.fact_shipping(lines, by_day=True),
        }
        for fact, build in builds.items():
            lake.make("gold", fact, inputs[fact], build, **options[fact])


def run_gold(
    lake: Lake,
    first_day: date = calendar.FIRST_DAY,
    last_day: date = calendar.LAST_DAY,
    by_day: bool = False,
    by_curve: bool = False,
) -> None:
    run_dimensions(lake, first_day, last_day)
    run_facts(lake, by_day, by_curve)


def run_measures(lake: Lake) -> None:
    """Response days, next to the reviews that they belong to."""
    lake.make(
        "gold",
        schemas.RESPONSES,
        ["silver.order_reviews"],
        lambda: gold.review_response_days(lake.table("silver", "order_reviews")),
    )


def run_segments(
    lake: Lake, csv_folder: str | None = None, partitions: int = segments.LAYOUT_PARTITIONS
) -> None:
    """``partitions`` is the layout that k-means starts from; see ``segments.fit_segments``."""
    with working_folder(lake.spark) as folder:

        def build() -> DataFrame:
            totals = segments.rfm_totals(
                lake.table("gold", "fact_sales"),
                lake.table("gold", "dim_date"),
                lake.table("gold", "dim_customers"),
            )
            features = segments.rfm_features(store(totals, "rfm_totals", folder))
            return segments.segment(features, partitions=partitions, folder=folder)

        inputs = ["gold.fact_sales", "gold.dim_date", "gold.dim_customers"]
        lake.make("gold", schemas.SEGMENTS, inputs, build, partitions=partitions)
    if csv_folder is not None:
        export_csv(lake.table("gold", schemas.SEGMENTS), csv_folder)


def run_all(
    lake: Lake,
    first_day: date = calendar.FIRST_DAY,
    last_day: date = calendar.LAST_DAY,
    by_day: bool = False,
    csv_folder: str | None = None,
) -> None:
    """Every table of the lake, in the order in which they depend on one another."""
    run_silver(lake)
    run_gold(lake, first_day, last_day, by_day)
    run_measures(lake)
    run_segments(lake, csv_folder)
