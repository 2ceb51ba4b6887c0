"""What Spark does with the queries: no Python, no all-pairs joins, hot keys split."""

from datetime import date
from decimal import Decimal

import pytest
from tests.conftest import executed_plan, rows
from pyspark.sql import functions as F

from feira import queries, schemas
from feira.operators import orphans
from feira.operators.lookup import translate_or_keep
from feira.plans import gold, segments, silver
from feira.sources.market import _with_copies
from feira.sources.working import new_folder
from feira.sources.working import store as store_in

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_no_python_and_no_all_pairs(spark, name):
    df = queries.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "ArrowEval", "MapInPandas", "CartesianProduct", "NestedLoopJoin"):
        assert node not in plan


ROWS = 12_000


def store(df, label):
    return store_in(df, label, new_folder(df.sparkSession))


@pytest.fixture
def hot(spark, conf):
    """Silver tables in which one order, person, account, product and seller each hold a
    third of the rows, stored in several files, with thresholds low enough to notice."""
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="1",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="1KB",
        adaptive__coalescePartitions__enabled="false",
        shuffle__partitions="12",
    )
    n = F.col("id")

    def key(prefix, modulus, third):
        """One value for a third of the rows, many for the others."""
        other = F.concat(F.lit(prefix), (n % modulus).cast("string"))
        return F.when(n % 3 == third, prefix + "hot").otherwise(other)

    def table(layer_name, df, parts=8):
        declared = schemas.struct(schemas.SILVER[layer_name])
        typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in declared]
        return store(df.select(*typed).repartition(parts), layer_name)

    moment = F.lit("2017-01-01").cast("timestamp")
    base = spark.range(ROWS)
    orders = spark.range(ROWS // 2)
    return {
        "orders": table(
            "orders",
            orders.select(
                F.when(n == 0, "ohot").otherwise(F.concat(F.lit("o"), n)).alias("order_id"),
                key("c", ROWS, 0).alias("customer_id"),
                F.lit("x").alias("order_status"),
                moment.alias("order_purchase_timestamp"),
                moment.alias("order_approved_at"),
                moment.alias("order_delivered_carrier_date"),
                F.expr("timestamp'2017-01-01' + make_dt_interval(int(id % 9))").alias(
                    "order_delivered_customer_date"
                ),
                moment.alias("order_estimated_delivery_date"),
            ),
        ),
        "customers": table(
            "customers",
            base.select(
                F.when(n == 0, "chot").otherwise(F.concat(F.lit("c"), n)).alias("customer_id"),
                key("u", ROWS, 1).alias("customer_unique_id"),
                F.lit(1).alias("customer_zip_code_prefix"),
                F.lit("rio").alias("customer_city"),
                F.lit("RJ").alias("customer_state"),
            ),
        ),
        "order_items": table(
            "order_items",
            base.select(
                key("o", ROWS // 2, 0).alias("order_id"),
                n.alias("order_item_id"),
                key("p", 900, 1).alias("product_id"),
                key("s", 800, 2).alias("seller_id"),
                moment.alias("shipping_limit_date"),
                F.lit(1).alias("price"),
                F.lit(1).alias("freight_value"),
            ),
        ),
        "order_payments": table(
            "order_payments",
            base.select(
                key("o", ROWS // 2, 0).alias("order_id"),
                n.alias("payment_sequential"),
                F.lit("voucher").alias("payment_type"),
                F.lit(1).alias("payment_installments"),
                F.lit(1).alias("payment_value"),
            ),
        ),
        "order_reviews": table(
            "order_reviews",
            spark.range(600).select(
                F.concat(F.lit("r"), n).alias("review_id"),
                key("o", 600, 0).alias("order_id"),
                F.lit(5).alias("review_score"),
                F.lit(None).alias("review_comment_title"),
                F.lit("bom").alias("review_comment_message"),
                moment.alias("review_creation_date"),
                moment.alias("review_answer_timestamp"),
            ),
        ),
        "products": table(
            "products",
            spark.range(900).select(
                F.when(n == 0, "phot").otherwise(F.concat(F.lit("p"), n)).alias("product_id"),
                *[F.lit(1).alias(c) for c in silver.PRODUCT_COUNTS + silver.PRODUCT_SIZES],
                F.lit("toys").alias("product_category_name"),
            ),
        ),
        "sellers": table(
            "sellers",
            spark.range(800).select(
                F.when(n == 0, "shot").otherwise(F.concat(F.lit("s"), n)).alias("seller_id"),
                F.lit(1).alias("seller_zip_code_prefix"),
                F.lit("rio").alias("seller_city"),
                F.lit("RJ").alias("seller_state"),
            ),
        ),
    }


@pytest.fixture
def hot_lines(hot):
    header = gold.order_header(
        hot["orders"],
        hot["customers"],
        gold.dim_customers(hot["customers"]),
        hot["order_payments"],
    )
    dims = gold.dim_products(hot["products"]), gold.dim_sellers(hot["sellers"])
    return gold.order_lines(hot["order_items"], header, *dims)


def split_joins(plan):
    """Key of each join that adaptive execution has split."""
    lines = [line for line in plan.splitlines() if "SortMergeJoin(skew=true)" in line]
    return [line.split("[", 1)[1].split("#", 1)[0] for line in lines]


def test_fact_sales_splits_every_hot_join(hot_lines, conf):
    sales = gold.fact_sales(hot_lines)
    found = split_joins(executed_plan(sales))
    assert sorted(found) == [
        "customer_id", "customer_unique_id", "order_id", "product_id", "seller_id",
    ]
    expected = rows(sales)
    assert len(expected) == ROWS
    conf(adaptive__enabled="false")
    assert rows(gold.fact_sales(hot_lines)) == expected


def test_fact_shipping_splits_every_hot_join(hot_lines):
    found = split_joins(executed_plan(gold.fact_shipping(hot_lines)))
    assert {"order_id", "product_id", "seller_id", "customer_id"} <= set(found)


def test_distances_split_every_hot_join(spark, hot, conf):
    """Also with all customers in one place; and no shipment is shuffled by a hash."""
    places = spark.createDataFrame([(1, -22.9, -43.2, "rio", "RJ")], schemas.SILVER["geolocation"])
    places = store(places, "geolocation")
    customers = gold.dim_customers(hot["customers"])
    header = gold.order_header(hot["orders"], hot["customers"], customers, None, places)
    dims = gold.dim_products(hot["products"]), gold.dim_sellers(hot["sellers"])
    far = gold.fact_shipping(gold.order_lines(hot["order_items"], header, *dims, places))
    plan = executed_plan(far)
    found = split_joins(plan)
    assert {"order_id", "product_id", "seller_id", "customer_id"} <= set(found)
    assert "hashpartitioning(customer_key" not in plan
    assert "hashpartitioning(seller_key" not in plan


def test_fact_reviews_splits_the_hot_order(hot, hot_lines, conf):
    """A third of the reviews and of the items belong to one order."""
    reviews = gold.fact_reviews(hot["order_reviews"], hot_lines)
    plan = executed_plan(reviews)
    assert split_joins(plan).count("order_id") == 2
    expected = reviews.count()
    assert expected > 200 * 2400  # reviews by (product, seller) pairs of the hot order
    conf(adaptive__enabled="false")
    assert gold.fact_reviews(hot["order_reviews"], hot_lines).count() == expected


def test_copies_are_split_too(spark, hot):
    """A third of all items are copies of one row: no key could spread them."""
    copy = hot["order_items"].filter("order_id = 'ohot'").limit(1)
    copies = copy.crossJoin(spark.range(ROWS // 2, numPartitions=6)).drop("id")
    items = store(hot["order_items"].unionByName(copies), "order_items")
    header = gold.order_header(
        hot["orders"], hot["customers"], gold.dim_customers(hot["customers"])
    )
    dims = gold.dim_products(hot["products"]), gold.dim_sellers(hot["sellers"])
    lines = gold.order_lines(items, header.selectExpr("*", "1 AS payment_value"), *dims)
    sales = gold.fact_sales(lines.selectExpr("*", "1 AS payment_installments"))
    plan = executed_plan(sales)
    assert {"order_id", "product_id", "seller_id"} <= set(split_joins(plan))
    assert sales.count() == ROWS


def test_items_are_not_shuffled_by_customer(hot, hot_lines):
    """The customer is resolved per order: his key never partitions item rows."""
    plan = gold.fact_sales(hot_lines)._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Exchange hashpartitioning(customer" in line:
            assert "order_item_id" not in line


def test_unused_dimension_joins_disappear(hot, hot_lines):
    plan = gold.fact_reviews(hot["order_reviews"], hot_lines)._jdf.queryExecution()
    text = plan.optimizedPlan().toString()
    assert "product_known" not in text and "seller_known" not in text
    assert "payment_value" not in text


def test_hashes_are_made_after_the_last_shuffle(hot, hot_lines):
    for fact in (
        gold.fact_sales(hot_lines),
        gold.fact_shipping(hot_lines, by_day=True),
        gold.fact_reviews(hot["order_reviews"], hot_lines),
    ):
        assert "sha2" in fact._jdf.queryExecution().optimizedPlan().toString().splitlines()[0]
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert "sha2" not in plan[plan.index("Exchange") :]


def test_rfm_reads_three_of_nine_columns_of_the_sales(spark, hot_lines):
    sales = store(gold.fact_sales(hot_lines), "fact_sales")
    customers = store(sales.select("customer_key").distinct().selectExpr(
        "customer_key", "customer_key AS customer_unique_id", "1 AS customer_zip_code_prefix",
        "'rio' AS customer_city", "'RJ' AS customer_state"), "dim_customers")
    totals = segments.rfm_totals(sales, gold.dim_date(spark), customers)
    scans = [
        line
        for line in totals._jdf.queryExecution().executedPlan().toString().splitlines()
        if "FileScan" in line and "sale_key" in line
    ]
    assert len(scans) == 1
    assert "freight_value" not in scans[0] and "product_key" not in scans[0]


def test_rfm_with_a_hot_customer_and_a_hot_day(spark, hot_lines, conf):
    """Sums are made per task, so the hot customer is one row when customers are joined."""
    sales = store(gold.fact_sales(hot_lines), "fact_sales")
    customers = store(
        sales.select("customer_key").distinct().selectExpr(
            "customer_key", "customer_key AS customer_unique_id",
            "'rio' AS customer_city", "'RJ' AS customer_state",
        ),
        "customers",
    )
    totals = segments.rfm_totals(sales, store(gold.dim_date(spark), "dim_date"), customers)
    plan = executed_plan(totals)
    assert "date_key" in split_joins(plan)
    assert plan.count("partial_count") >= 1
    expected = rows(totals)
    conf(adaptive__enabled="false")
    assert rows(totals.select("*")) == expected


def test_orphans_of_a_hot_key_are_counted_before_the_shuffle(hot):
    """A third of the items miss the same order: each task sends one row for it."""
    known = store(hot["orders"].filter("order_id <> 'ohot'"), "known_orders")
    report = orphans([("order_items", hot["order_items"], "orders", known, "order_id")])
    plan = executed_plan(report)
    assert plan.index("Exchange hashpartitioning(key") < plan.index("partial_bit_or")
    [row] = rows(report)
    assert row[:3] == ("order_items", "orders", "order_id") and row[4] == 1
    assert row[3] == ROWS // 3


def test_a_hot_category_is_split(spark, hot):
    """Also null: a third of the products have one category, a third have none."""
    n = F.col("id")
    kind = F.when(n % 3 == 0, "hot").when(n % 3 == 1, F.concat(F.lit("k"), (n % 50).cast("string")))
    products = store(
        spark.range(ROWS).select(n.alias("product_id"), kind.alias("category")).repartition(8),
        "some_products",
    )
    lookup = store(
        spark.range(50).selectExpr("concat('k', id) AS category", "concat('e', id) AS english"),
        "some_translation",
    )
    named = translate_or_keep(products, lookup.union(
        spark.createDataFrame([("hot", "warm")], "category string, english string")
    ), "category", "english")
    counted = named.groupBy("category").count()
    assert "category" in split_joins(executed_plan(counted))
    found = {row.category: row["count"] for row in counted.collect()}
    assert found["warm"] == ROWS // 3 and found[None] == ROWS // 3


def test_features_and_their_scores_read_the_sales_once(spark, monkeypatch):
    """The facts are computed for the totals alone; the rest reads one row per person."""
    computed = []
    build = segments.rfm_totals
    monkeypatch.setattr(segments, "rfm_totals", lambda *a: computed.append(1) or build(*a))
    for name in ("rfm_features", "rfm_scaled", "rfm_assign_fixed"):
        df = queries.queries()[name](spark, "/root/testdata/sf0.001")
        assert all("rfm_totals" in path for path in df.inputFiles()), name
        plan = executed_plan(df)
        assert "Join" not in plan and plan.count("Exchange SinglePartition") == 1
    assert len(computed) == 3


def test_equal_features_and_a_single_person_have_no_score(frame):
    def scores(*rows_):
        totals = frame(
            "customer_unique_id string, customer_city string, customer_state string, last_day date, "
            "Frequency bigint, Monetary decimal(38,2)",
            *rows_,
        )
        return [tuple(row[3:]) for row in rows(segments.rfm_scaled(totals))]

    day, cents = date(2017, 1, 1), Decimal("5.00")
    assert scores(("u", "c", "s", day, 1, cents)) == [(0.0, 0.0, 0.0)]
    assert scores(*[(u, "c", "s", day, 1, cents) for u in "abc"]) == [(0.0, 0.0, 0.0)] * 3
    found = scores(("a", "c", "s", day, 1, None), ("b", "c", "s", date(2017, 1, 3), 3, cents))
    assert [[round(x, 6) for x in row] for row in found] == [[0.707107, -0.707107, -0.707107], [-0.707107, 0.707107, 0.707107]]


def test_orphans_take_one_shuffle_per_key(spark, frame):
    """Three links on one key and one on another; a third of all children share a key."""
    children = spark.range(3000).selectExpr("IF(id % 3 = 0, 7, id % 900) AS k", "id % 5 AS l")
    parents = spark.range(800).selectExpr("id AS k")
    links = [("a", children, "p", parents, "k"), ("b", children, "p", parents, "k")]
    links += [("a", children, "q", parents.limit(0), "k"), ("a", children, "r", spark.range(4).toDF("l"), "l")]
    found = orphans(links)
    plan = executed_plan(found)
    assert plan.count("Exchange hashpartitioning(key") == 2 and "Join" not in plan
    expected = []
    for name, child, parent_name, parent, key in links:
        missing = child.join(parent, key, "left_anti")
        expected.append((name, parent_name, key, missing.count(), missing.select(key).distinct().count()))
    assert rows(found) == sorted(expected, key=repr)


def test_rules_add_up_to_the_rows_dropped(spark):
    found = queries.queries()
    audit = {r.table_name: r.rows_dropped for r in found["audit_counts"](spark, "/root/testdata/sf0.001").collect()}
    by_rule = {}
    for row in found["audit_rules"](spark, "/root/testdata/sf0.001").collect():
        by_rule[row.table_name] = by_rule.get(row.table_name, 0) + row.rows_dropped
    assert by_rule == audit and sum(audit.values()) > 0


@pytest.mark.parametrize(
    "name", ["fact_sales", "silver_orders", "silver_payments", "silver_products", "silver_order_reviews"]
)
def test_copies_are_dealt_by_compiled_code(spark, name):
    """A lambda over an array made for each row took about half the time of reading the items."""
    df = queries.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in plan and "lambda" not in plan


def test_copies_of_every_combination_of_conditions(frame):
    """A condition that is null counts as not met, for each of them."""
    marks = [True, False, None]
    given = [(f"{a}{b}{c}", a, b, c) for a in marks for b in marks for c in marks]
    df = frame("id string, a boolean, b boolean, c boolean", *given)
    changed = [(F.col(name), {"id": F.concat("id", F.lit(name))}) for name in "abc"]
    found = [row.id for row in _with_copies(df, *changed).collect()]
    expected = [row[0] + mark for row in given for mark in ["", *(n for n, met in zip("abc", row[1:]) if met)]]
    assert sorted(found) == sorted(expected)
