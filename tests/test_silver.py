from datetime import datetime
from decimal import Decimal

from tests.conftest import rows

from feira import schemas
from feira.plans import silver


def bronze(frame, entity, *data):
    return frame(schemas.BRONZE[entity], *data)


def same_columns(df, table):
    declared = schemas.struct(schemas.SILVER[table])
    return [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in declared]


def test_customers(frame):
    df = silver.customers(
        bronze(
            frame,
            "customers",
            ("c1", "u1", 1, "São Paulo", "SP"),
            ("c1", "u1", 1, "São Paulo", "SP"),
            ("c2", "u1", 2, " 12 ", "SP"),
            ("c3", "u2", 3, None, "RJ"),
            (None, "u3", 4, "Rio", "RJ"),
            ("c4", "u4", 5, "Rio 2", "RJ"),
        )
    )
    assert same_columns(df, "customers")
    assert rows(df) == [("c1", "u1", 1, "sao paulo", "SP"), ("c4", "u4", 5, "rio", "RJ")]


def test_customers_pick_before_looking_at_the_city(frame):
    """The smallest row of c1 has no usable city, so c1 goes even though another has one."""
    df = bronze(frame, "customers", ("c1", "u1", 1, "12", "SP"), ("c1", "u1", 2, "Rio", "RJ"))
    assert rows(silver.customers(df)) == []


def order(key, *stages, customer="c1"):
    return (key, customer, "delivered", *stages, "2017-02-01 00:00:00")


def test_orders(frame):
    df = silver.orders(
        bronze(
            frame,
            "orders",
            order("ok", "2017-01-01 10:00:00", "2017-01-02", "2017-01-03", "2017-01-04"),
            order("open", "2017-01-01 10:00:00", None, None, None),
            order("late", "2017-01-01 10:00:00", "2017-01-02", None, "2017-01-04"),
            order("back", "2017-01-03", "2017-01-02", "2017-01-03", "2017-01-04"),
            order("text", "2017-01-01", "never", "", None),
            order(None, "2017-01-01", None, None, None),
        )
    )
    assert same_columns(df, "orders")
    kept = {row.order_id: row for row in df.collect()}
    assert set(kept) == {"ok", "open", "text"}
    assert kept["text"].order_approved_at is None
    moment = df.filter("order_id = 'ok'").selectExpr(
        "cast(order_purchase_timestamp as timestamp_ntz)"
    )
    assert moment.first()[0] == datetime(2017, 1, 1, 10)


def test_orders_filter_before_the_pick(frame):
    """The smallest row of o1 is out of order; the next one is still there to be picked."""
    df = bronze(
        frame,
        "orders",
        order("o1", "2017-01-05", "2017-01-02", None, None, customer="c1"),
        order("o1", "2017-01-01", "2017-01-02", None, None, customer="c2"),
    )
    assert [row.customer_id for row in silver.orders(df).collect()] == ["c2"]


def product(key, category="a", name=10.0, weight=1.0):
    return (key, category, name, 20.0, 2.0, weight, 1.0, 1.0, 1.0)


def test_products(frame):
    lookup = frame(schemas.LOOKUPS[schemas.TRANSLATION], ("a", "english a"))
    df = silver.products(
        bronze(
            frame,
            "products",
            product("p1", name=12.7),
            product("p2", weight=-1.0),
            product("p3", weight=None),
            product("p4", name=-0.5),
            product("p5", name=-1.0),
            product("p6", category="b"),
            product("p7", category=None),
            product(None),
            product(None),
        ),
        lookup,
    )
    assert same_columns(df, "products")
    assert rows(df.select("product_id", "product_name_length", "product_category_name")) == sorted(
        [
            ("p1", 12, "english a"),
            ("p3", 10, "english a"),
            ("p4", 0, "english a"),
            ("p6", 10, "b"),
            ("p7", 10, None),
            (None, 10, "english a"),
        ],
        key=repr,
    )


def test_products_pick_before_the_measures_are_checked(frame):
    lookup = frame(schemas.LOOKUPS[schemas.TRANSLATION])
    df = bronze(frame, "products", product("p1", weight=-1.0), product("p1", weight=1.0))
    assert rows(silver.products(df, lookup)) == []


def test_sellers_keep_empty_cities(frame):
    df = silver.sellers(
        bronze(
            frame,
            "sellers",
            ("s1", 1, "4482255", "SP"),
            ("s2", 2, None, "SP"),
            ("s2", 2, "Rio", "RJ"),
            (None, 3, "Açaí", "PA"),
        )
    )
    assert same_columns(df, "sellers")
    assert rows(df) == sorted(
        [("s1", 1, "", "SP"), ("s2", 2, None, "SP"), (None, 3, "acai", "PA")], key=repr
    )


def test_order_items(frame):
    def item(key, price, freight):
        return (key, 1, "p", "s", "2017-01-01 00:00:00", price, freight)

    zero, one, below = Decimal("0.00"), Decimal("1.00"), Decimal("-0.01")
    df = silver.order_items(
        bronze(
            frame,
            "order_items",
            item("a", zero, zero),
            item("a", zero, zero),
            item("b", below, one),
            item("c", one, below),
            item("d", None, one),
            item("e", one, None),
        )
    )
    assert same_columns(df, "order_items")
    assert [row.order_id for row in df.collect()] == ["a", "a"]


def test_order_reviews(frame):
    def review(key, score):
        return (key, "o", score, None, "ok", "2017-01-01", "2017-01-02 10:00:00")

    scores = [0, 1, 5, 6, None]
    df = silver.order_reviews(
        bronze(frame, "order_reviews", *[review(f"r{score}", score) for score in scores])
    )
    assert same_columns(df, "order_reviews")
    assert sorted(row.review_id for row in df.collect()) == ["r1", "r5"]


def test_order_payments(frame):
    row = ("o1", 1, "voucher", 1, Decimal("10.00"))
    other = ("o1", 1, "voucher", 1, Decimal("10.01"))
    df = silver.order_payments(bronze(frame, "order_payments", row, row, other))
    assert same_columns(df, "order_payments")
    assert rows(df) == [row, other]


def test_geolocation(frame):
    df = silver.geolocation(
        bronze(
            frame,
            "geolocation",
            (1, 10.0, 20.0, "São B", "SP"),
            (1, 20.0, 40.0, "São A", "SP"),
            (1, 90.0001, 0.0, "A", "AA"),
            (1, 0.0, -180.5, "A", "AA"),
            (2, 90.0, 180.0, "77", "RJ"),
            (2, 90.0, 180.0, "Rio", "RJ"),
            (3, -90.0, -180.0, "Rio", "RJ"),
            (4, None, 1.0, "Rio", "RJ"),
        )
    )
    assert same_columns(df, "geolocation")
    assert rows(df) == [(1, 15.0, 30.0, "sao a", "SP"), (3, -90.0, -180.0, "rio", "RJ")]


def test_filters_on_plain_columns_reach_the_scan(spark, frame, conf, tmp_path):
    conf(maxMetadataStringLength="1000")
    path = str(tmp_path / "items")
    bronze(frame, "order_items").write.parquet(path)
    df = silver.order_items(spark.read.parquet(path)).select("order_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(price" in plan and "GreaterThanOrEqual(freight_value" in plan
    assert "ReadSchema: struct<order_id:string,price:decimal(18,2),freight_value" in plan


def test_key_filter_moves_below_the_pick(spark, frame, conf, tmp_path):
    conf(maxMetadataStringLength="1000")
    path = str(tmp_path / "customers")
    bronze(frame, "customers").write.parquet(path)
    plan = silver.customers(spark.read.parquet(path))._jdf.queryExecution().executedPlan()
    assert "PushedFilters: [IsNotNull(customer_id)]" in plan.toString()
