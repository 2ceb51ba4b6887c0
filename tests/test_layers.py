"""Whole runs over the smallest test tables, from files to segments."""

from pathlib import Path

import pytest
from tests.conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from feira import queries, schemas
from feira.plans import layers
from feira.sources import exports, sinks
from feira.sources.market import Market

FOLDER = "/root/testdata/sf0.001"


def bronze_frames(spark):
    market = Market(spark, FOLDER)
    return {
        "customers": market.customers(),
        "orders": market.orders(),
        "order_items": market.order_items(),
        "order_payments": market.order_payments(),
        "products": market.products(),
        "sellers": market.sellers(),
        "order_reviews": market.order_reviews(),
        "geolocation": market.geolocation(),
        schemas.TRANSLATION: market.translation(),
    }


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bronze"))
    for entity, df in bronze_frames(spark).items():
        sinks.write_parquet(df, f"{root}/{entity}")
    lake = layers.Lake(spark, root)
    layers.run_silver(lake)
    layers.run_gold(lake, queries.FIRST_DAY, queries.LAST_DAY)
    layers.run_measures(lake)
    layers.run_segments(lake, csv_folder=f"{root}/export", partitions=3)
    return lake


def same(table, name, spark):
    expected = queries.queries()[name](spark, FOLDER)
    assert rows(queries._comparable(table)) == rows(expected.select(*table.columns))


@pytest.mark.parametrize(
    "table, query",
    [
        ("customers", "silver_customers"),
        ("orders", "silver_orders"),
        ("products", "silver_products"),
        ("sellers", "silver_sellers"),
        ("order_items", "silver_order_items"),
        ("order_reviews", "silver_order_reviews"),
        ("order_payments", "silver_payments"),
    ],
)
def test_silver_tables(lake, spark, table, query):
    same(lake.table("silver", table), query, spark)


@pytest.mark.parametrize(
    "name",
    [
        "dim_customers",
        "dim_products",
        "dim_sellers",
        "fact_sales",
        "fact_reviews",
        "fact_shipping",
        "review_response_days",
    ],
)
def test_gold_tables(lake, spark, name):
    table = lake.table("gold", name)
    query = {"fact_sales": "sales_with_voucher", "fact_shipping": "shipping_distance"}
    shown = table
    if name == "fact_shipping":
        km = F.round("shipping_distance_km", 4)
        shown = table.withColumn("shipping_distance_km", km)
        assert not table.filter("shipping_distance_km > 0").isEmpty()
    same(shown, query.get(name, name), spark)
    if name in schemas.GOLD:
        declared = schemas.struct(schemas.GOLD[name])
        assert table.columns == declared.names
    if name.startswith("dim"):
        assert [(f.name, f.dataType) for f in table.schema] == [
            (f.name, f.dataType) for f in declared
        ]


def test_segments(lake, spark):
    table = lake.table("gold", schemas.SEGMENTS)
    same(table.drop("Cluster"), "rfm_features", spark)
    assert table.filter("Cluster is null or Cluster not between 0 and 3").isEmpty()
    exported = spark.read.csv(f"{lake.bronze_root}/export", header=True)
    assert exported.columns == table.columns
    assert exported.count() == table.count() > 0


def test_runs_leave_no_working_files(spark, lake):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("feira-*"))
    layers.run_facts(lake)
    layers.run_segments(lake)
    assert set(shared.glob("feira-*")) == before


def test_shipping_is_written_in_day_order(lake):
    files = lake.table("gold", "fact_shipping").select(
        F.input_file_name().alias("file"), "date_key"
    )
    spans = files.groupBy("file").agg(F.min("date_key"), F.max("date_key")).collect()
    spans = sorted(tuple(span[1:]) for span in spans)
    assert all(before[1] <= after[0] for before, after in zip(spans, spans[1:]))


def test_sales_in_day_order_are_skipped_by_file(lake, spark):
    layers.run_facts(lake, by_day=True)
    for name in ("fact_sales", "fact_reviews"):
        table = lake.table("gold", name)
        spans = table.groupBy(F.input_file_name()).agg(F.min("date_key"), F.max("date_key"))
        spans = sorted(tuple(span[1:]) for span in spans.collect())
        assert all(before[1] <= after[0] for before, after in zip(spans, spans[1:]))
        day = spans[0][0]
        assert len([1 for first, last in spans if first <= day <= last]) <= max(1, len(spans) - 1)


def test_days_are_counted_in_utc(spark, conf):
    conf(session__timeZone="America/Sao_Paulo")
    with pytest.raises(ValueError, match="UTC"):
        layers.Lake(spark, "anywhere")


def test_audit_adds_up(lake):
    audit = layers.audit_silver(lake)
    assert audit.count() == 8
    assert audit.filter("rows_in <> rows_out + rows_dropped").isEmpty()
    kept = {row.table_name: row.rows_out for row in audit.collect()}
    assert kept["orders"] == lake.table("silver", "orders").count()


def test_links_match_the_facts(lake):
    links = {(r.child_table, r.parent_table): r.orphan_rows for r in layers.audit_links(lake).collect()}
    items, orders = lake.table("silver", "order_items"), lake.table("silver", "orders")
    unknown = items.join(orders, "order_id", "left_anti").count()
    assert links["order_items", "orders"] == unknown > 0


def test_running_again_gives_the_same_tables(lake, spark):
    before = {t: rows(lake.table("gold", t)) for t in ("fact_sales", "fact_shipping")}
    layers.run_silver(lake)
    layers.run_gold(lake, queries.FIRST_DAY, queries.LAST_DAY)
    assert {t: rows(lake.table("gold", t)) for t in before} == before


def test_a_table_cannot_be_replaced_by_itself(lake):
    with pytest.raises(AnalysisException):
        lake.write(lake.table("silver", "sellers"), "silver", "sellers")
    assert lake.table("silver", "sellers").count() == 11


def test_from_csv_exports(lake, spark, tmp_path):
    """Dates and numbers arrive as text and end in the same dimensions and facts."""
    folder = tmp_path / "exports"
    folder.mkdir()
    names = {schemas.TRANSLATION: f"{schemas.TRANSLATION}.csv"}
    for entity, df in bronze_frames(spark).items():
        text = df.select([F.col(c).cast("string") for c in df.columns]).toPandas()
        text.to_csv(folder / names.get(entity, f"shop_{entity}_dataset.csv"), index=False)
    root = str(tmp_path / "bronze")
    assert set(exports.ingest_folder(spark, str(folder), root)) == set(bronze_frames(spark))
    from_csv = layers.Lake(spark, root)
    silver = {table: build(from_csv) for table, build in layers.SILVER.items()}
    for table, declared in schemas.SILVER.items():
        types = [(f.name, f.dataType) for f in schemas.struct(declared)]
        assert [(f.name, f.dataType) for f in silver[table].schema] == types
        if table != "order_payments":  # four decimals in the test tables, two in an export
            assert rows(silver[table]) == rows(lake.table("silver", table)), table
