import hashlib
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from tests.conftest import rows
from pyspark.sql import functions as F

from feira import schemas
from feira.plans import gold
from feira.sources import calendar


def sha(*parts):
    return hashlib.sha256("||".join(map(str, parts)).encode()).hexdigest()


def at(*parts):
    return datetime(*parts, tzinfo=timezone.utc)


def same_columns(df, table):
    declared = schemas.struct(schemas.GOLD[table])
    return [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in declared]


@pytest.fixture
def silver(frame):
    """Two persons, one with two accounts; o1 has three items, o2 one, o9 no items."""
    money = Decimal
    tables = {
        "customers": [
            ("c1", "u1", 11, "rio", "RJ"),
            ("c2", "u1", 12, "rio", "RJ"),
            ("c3", "u2", 13, "natal", "RN"),
            ("c4", None, 14, "natal", "RN"),
        ],
        "orders": [
            # key, account, status, purchase, approved, carrier, delivered, estimated
            ("o1", "c2", "x", at(2017, 1, 1, 23), None, None, at(2017, 1, 10, 10), at(2017, 1, 10)),
            ("o2", "c3", "x", at(2017, 1, 2), None, None, None, at(2017, 1, 20)),
            ("o3", "c9", "x", at(2017, 1, 3), None, None, at(2017, 1, 4), None),
            ("o4", "c4", "x", None, None, None, at(2017, 1, 4), at(2017, 1, 5)),
            ("o9", "c1", "x", at(2017, 1, 4), None, None, at(2017, 1, 5), at(2017, 1, 9)),
        ],
        "order_items": [
            ("o1", 1, "p1", "s1", None, money("10.00"), money("1.00")),
            ("o1", 1, "p1", "s1", None, money("10.00"), money("1.00")),
            ("o1", 2, "p1", "s1", None, money("10.00"), money("1.00")),
            ("o1", 3, "p2", "s1", None, money("30.00"), money("1.00")),
            ("o2", 1, "gone", "s2", None, money("5.00"), money("0.00")),
            ("o2", 1, "gone too", "s2", None, money("5.00"), money("0.00")),
            ("o3", 1, "p1", None, None, money("7.00"), money("0.00")),
            ("o4", 1, "p1", "s1", None, money("8.00"), money("0.00")),
            ("unknown", 1, "p1", "s1", None, money("9.00"), money("0.00")),
        ],
        "order_payments": [
            ("o1", 1, "voucher", 1, money("10.00")),
            ("o1", 2, "credit_card", 3, money("20.50")),
            ("o2", 1, None, 1, money("5.00")),
        ],
        "products": [
            ("p1", 1, 1, 1, 1.0, 2.0, 3.0, 4.0, "toys"),
            ("p2", 1, 1, 1, None, 2.0, 3.0, 4.0, None),
        ],
        "sellers": [("s1", 11, "rio", "RJ"), ("s2", 99, "", "RN"), (None, 1, "x", "Y")],
        "order_reviews": [
            ("r1", "o1", 5, None, "bom!", at(2017, 1, 11), at(2017, 1, 13, 1)),
            ("r1", "o1", 5, None, "bom!", at(2017, 1, 11), at(2017, 1, 13, 1)),
            ("r2", "o2", 1, None, None, at(2017, 1, 12, 23), at(2017, 1, 13, 1)),
            ("r3", "o9", 3, None, "sem itens", at(2017, 1, 12), None),
            ("r4", "unknown", 3, None, "?", at(2017, 1, 12), None),
        ],
        "geolocation": [
            (11, -22.9, -43.2, "rio", "RJ"),
            (12, -23.55, -46.63, "sao paulo", "SP"),
        ],
    }
    return {name: frame(schemas.SILVER[name], *data) for name, data in tables.items()}


@pytest.fixture
def dims(silver):
    return {
        "customers": gold.dim_customers(silver["customers"]),
        "products": gold.dim_products(silver["products"]),
        "sellers": gold.dim_sellers(silver["sellers"]),
    }


@pytest.fixture
def lines(silver, dims):
    header = gold.order_header(
        silver["orders"], silver["customers"], dims["customers"], silver["order_payments"]
    )
    return gold.order_lines(silver["order_items"], header, dims["products"], dims["sellers"])


def test_dim_customers_one_row_per_person(dims):
    assert same_columns(dims["customers"], "dim_customers")
    assert rows(dims["customers"]) == sorted(
        [
            (sha("u1"), "u1", 11, "rio", "RJ"),
            (sha("u2"), "u2", 13, "natal", "RN"),
            (sha(""), None, 14, "natal", "RN"),
        ],
        key=repr,
    )


def test_null_and_empty_natural_keys_share_a_row(frame):
    df = frame(schemas.SILVER["sellers"], ("", 1, "a", "A"), (None, 2, "b", "B"))
    assert rows(gold.dim_sellers(df)) == [(sha(""), None, 2, "b", "B")]


def test_dim_products(dims):
    assert same_columns(dims["products"], "dim_products")
    assert rows(dims["products"]) == sorted(
        [
            (sha("p1"), "p1", "toys", 1.0, 2.0, 3.0, 4.0),
            (sha("p2"), "p2", None, None, 2.0, 3.0, 4.0),
        ]
    )


def test_dim_sellers(dims):
    assert same_columns(dims["sellers"], "dim_sellers")
    assert dims["sellers"].count() == 3


def test_dim_date(spark):
    days = gold.dim_date(spark)
    assert same_columns(days, "dim_date")
    assert days.count() == 1461
    assert days.filter("is_weekend").count() == 418
    assert days.filter("is_holiday").count() == 0
    by_key = {row.date_key: row for row in days.collect()}
    assert by_key["20160101"].day_of_week == "Friday"
    assert not by_key["20160101"].is_weekend
    assert by_key["20160102"].day_of_week == "Saturday"
    assert by_key["20160102"].is_weekend
    assert by_key["20160103"].is_weekend
    assert by_key["20160229"].full_date == date(2016, 2, 29)
    assert by_key["20191231"][4:7] == (12, 4, 2019)


def test_days_spanned(frame):
    df = frame("t timestamp", (at(2017, 1, 1, 5),), (at(2017, 1, 3, 1),), (None,))
    assert rows(calendar.days_spanned(df, "t")) == [
        (date(2017, 1, 1),),
        (date(2017, 1, 2),),
        (date(2017, 1, 3),),
    ]


def test_days_spanned_by_nothing(frame):
    assert rows(calendar.days_spanned(frame("t timestamp"), "t")) == []


def test_payments_per_order(silver):
    assert rows(gold.payments_per_order(silver["order_payments"])) == [
        ("o1", Decimal("30.50"), 3, 1),
        ("o2", Decimal("5.00"), 1, 0),
    ]


def test_fact_sales(lines):
    sales = gold.fact_sales(lines)
    assert same_columns(gold.fact_sales(lines, with_voucher=True), "fact_sales")
    one, ten, total = Decimal("1.00"), Decimal("10.00"), Decimal("30.50")
    u1, p1, s1 = sha("u1"), sha("p1"), sha("s1")
    zero = Decimal("0.00")
    assert rows(sales) == sorted(
        [
            (sha("o1", 1), u1, p1, s1, "20170101", ten, one, total, 3),
            (sha("o1", 2), u1, p1, s1, "20170101", ten, one, total, 3),
            (sha("o1", 3), u1, sha("p2"), s1, "20170101", Decimal("30.00"), one, total, 3),
            # two unknown products leave two equal rows, which become one
            (sha("o2", 1), sha("u2"), None, sha("s2"), "20170102") + (Decimal("5.00"), zero)
            + (Decimal("5.00"), 1),
            # unknown account; null seller id does not meet the null seller's key
            (sha("o3", 1), None, p1, None, "20170103", Decimal("7.00"), zero, None, None),
            # the account has no person: null does not meet the null person's key
            (sha("o4", 1), None, p1, s1, None, Decimal("8.00"), zero, None, None),
        ],
        key=repr,
    )


def test_sales_with_voucher(lines):
    flags = gold.fact_sales(lines, with_voucher=True).select("sale_key", "is_voucher")
    by_key = dict(rows(flags))
    assert by_key[sha("o1", 1)] == 1
    assert by_key[sha("o2", 1)] == 0
    assert by_key[sha("o3", 1)] is None


def test_fact_shipping(lines):
    shipping = gold.fact_shipping(lines)
    nowhere = {name: F.lit(0.0) for name in gold.CUSTOMER_POSITION + gold.SELLER_POSITION}
    assert same_columns(gold.fact_shipping(lines.withColumns(nowhere)), "fact_shipping")
    u1, p1, s1 = sha("u1"), sha("p1"), sha("s1")
    assert rows(shipping) == sorted(
        [
            # 9 calendar days, on the estimated day but after the estimated time
            (sha("o1", 1, "s1"), u1, p1, s1, "20170101", 9, 0, True),
            (sha("o1", 2, "s1"), u1, p1, s1, "20170101", 9, 0, True),
            (sha("o1", 3, "s1"), u1, sha("p2"), s1, "20170101", 9, 0, True),
            # no estimate: not late
            (sha("o3", 1), None, p1, None, "20170103", 1, None, False),
        ],
        key=repr,
    )


def test_shipping_by_day(spark, lines, conf):
    """Same rows; days never go back, across partitions too, and one day is spread."""
    conf(adaptive__coalescePartitions__enabled="false")
    many = lines.crossJoin(spark.range(500)).withColumn("order_item_id", F.col("id").cast("int"))
    ordered = gold.fact_shipping(many, by_day=True)
    assert rows(ordered) == rows(gold.fact_shipping(many))
    days = [row.date_key for row in ordered.select("date_key").collect()]
    assert days == sorted(days) and len(set(days)) == 2
    parts = ordered.filter("date_key = '20170101'").select(F.spark_partition_id()).distinct()
    assert parts.count() > 1


def test_fact_reviews(silver, lines):
    reviews = gold.fact_reviews(silver["order_reviews"], lines)
    assert same_columns(reviews, "fact_reviews")
    plain = reviews.withColumn("response_time", F.col("response_time").cast("timestamp_ntz"))
    answered = datetime(2017, 1, 13, 1)
    u1, u2 = sha("u1"), sha("u2")
    assert rows(plain) == sorted(
        [
            # three items with p1 and s1 give one row, p2 another
            (sha("r1", "p1", "s1"), u1, "20170111", "o1", 5, 4, answered),
            (sha("r1", "p2", "s1"), u1, "20170111", "o1", 5, 4, answered),
            (sha("r2", "gone", "s2"), u2, "20170112", "o2", 1, 0, answered),
            (sha("r2", "gone too", "s2"), u2, "20170112", "o2", 1, 0, answered),
        ]
    )


def test_review_keys_that_skip_nulls_collapse(frame):
    """(r, null, x) and (r, x, null) have the same key, so they are one row."""
    reviews = frame(schemas.SILVER["order_reviews"], ("r", "o", 5, None, "", None, None))
    lines = frame(
        "order_id string, product_id string, seller_id string, person string",
        ("o", None, "x", "c"),
        ("o", "x", None, "c"),
    )
    expected = [(sha("r", "x"), sha("c"), None, "o", 5, 0, None)]
    assert rows(gold.fact_reviews(reviews, lines)) == expected


def test_review_response_days(silver):
    days = gold.review_response_days(silver["order_reviews"]).distinct()
    assert rows(days) == [("r1", "o1", 2), ("r2", "o2", 1), ("r3", "o9", None), ("r4", "unknown", None)]


def test_shipping_distance(silver, dims, frame):
    places = frame(
        schemas.SILVER["geolocation"],
        (11, -22.9, -43.2, "rio", "RJ"),
        (99, -23.55, -46.63, "sao paulo", "SP"),
    )
    header = gold.order_header(
        silver["orders"], silver["customers"], dims["customers"], None, places
    )
    placed = gold.order_lines(
        silver["order_items"], header, dims["products"], dims["sellers"], places
    )
    far = gold.fact_shipping(placed)
    near = gold.fact_shipping(placed.drop("customer_lat"))
    assert [c for c in far.columns if c != "shipping_distance_km"] == near.columns
    assert rows(far.drop("shipping_distance_km")) == rows(near)
    by_keys = {
        (row.customer_key, row.seller_key): row.shipping_distance_km for row in far.collect()
    }
    known = {pair: km for pair, km in by_keys.items() if km is not None}
    assert known.get((sha("u1"), sha("s1")), 0.0) == 0.0
    if (sha("u1"), sha("s2")) in known:
        assert known[sha("u1"), sha("s2")] == pytest.approx(357.855, abs=1e-3)
    assert all(km is None for (customer, _), km in by_keys.items() if customer is None)


def test_sales_cover_every_item_of_a_known_order(lines, silver):
    known = silver["order_items"].join(silver["orders"], "order_id", "left_semi")
    keys = known.select(F.sha2(F.concat_ws("||", "order_id", "order_item_id"), 256)).distinct()
    assert rows(gold.fact_sales(lines).select("sale_key").distinct()) == rows(keys)
