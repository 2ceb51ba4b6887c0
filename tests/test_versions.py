"""Tables of the session catalog: replaced in one step, stored in buckets, resumed."""

from pathlib import Path
from unittest.mock import patch
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F
from tests.conftest import executed_plan, rows

from feira import queries, schemas
from feira.plans import gold, layers, manifest, silver
from feira.sources import sinks, versions
from feira.sources.market import Market
from feira.sources.versions import Buckets

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def space(spark):
    """A namespace of its own."""
    names = [r.namespace for r in spark.sql("SHOW NAMESPACES").collect()]
    name = f"v{len(names)}_{abs(hash(tuple(names))) % 10**6}"
    spark.sql(f"CREATE NAMESPACE {name}")
    yield f"spark_catalog.{name}"
    spark.sql(f"DROP NAMESPACE {name} CASCADE")


def folders(spark, table):
    return [Path(urlparse(v).path) for v in versions.versions(spark, table)]


def broken(df):
    """Fails in one of its tasks, after others have written."""
    bad = F.when(F.col("id") == 7, F.raise_error(F.lit("broken"))).otherwise(F.col("id"))
    return df.withColumn("id", bad.cast("long"))


@pytest.mark.parametrize("buckets", [None, Buckets(4, ("id",))])
def test_a_failing_write_leaves_the_old_rows(spark, space, buckets):
    table = f"{space}.t"
    sinks.write_table(spark.range(5), table, buckets=buckets)
    before = rows(spark.table(table))
    with pytest.raises(Exception, match="broken"):
        sinks.write_table(broken(spark.range(100).repartition(4)), table, buckets=buckets)
    assert rows(spark.table(table)) == before == [(i,) for i in range(5)]
    sinks.write_table(spark.range(6), table, buckets=buckets)
    assert spark.table(table).count() == 6
    assert {t.name for t in spark.catalog.listTables(space)} == {"t"}


def test_a_write_that_never_came_to_its_switch_is_removed(spark, space):
    table = f"{space}.t"
    sinks.write_table(spark.range(5), table)
    with patch.object(versions, "switch", side_effect=RuntimeError("lost")), pytest.raises(RuntimeError):
        sinks.write_table(spark.range(50), table)
    assert spark.table(table).count() == 5 and len(folders(spark, table)) == 2
    left = folders(spark, table)[-1]
    sinks.write_table(spark.range(7), table)
    assert spark.table(table).count() == 7
    assert left not in folders(spark, table) and not left.exists()


def test_a_reader_opened_before_the_switch_finishes(spark, space):
    table = f"{space}.t"
    sinks.write_table(spark.range(0, 1000, 1, 4), table)
    opened = spark.table(table)
    lazy = spark.table(table).where("id >= 0")
    assert opened.count() == 1000
    sinks.write_table(spark.range(3), table)
    assert opened.agg(F.sum("id")).first()[0] == sum(range(1000))
    assert lazy.count() == 1000
    assert spark.table(table).count() == 3
    # older versions than the last one go
    for n in (4, 5):
        sinks.write_table(spark.range(n), table)
    assert len(folders(spark, table)) == 1 + versions.KEPT


def test_the_switch_is_one_change_of_the_location(spark, space):
    table = f"{space}.t"
    sinks.write_table(spark.range(5), table)
    said = []
    run = type(spark).sql
    with patch.object(type(spark), "sql", lambda self, text, *a: said.append(text) or run(self, text, *a)):
        sinks.write_table(spark.range(6), table)
    changes = [text.split()[:2] for text in said if not text.startswith("DESCRIBE")]
    assert changes == [["ALTER", "TABLE"]]


def test_other_columns_replace_the_entry_and_keep_all_rows(spark, space):
    table = f"{space}.t"
    sinks.write_table(spark.range(5), table)
    sinks.write_table(spark.range(4).selectExpr("id", "'x' AS name"), table)
    assert rows(spark.table(table)) == [(i, "x") for i in range(4)]
    # broken off between the two changes: nothing of the old rows is lost, and the next write works
    run = type(spark).sql

    def fail(self, text, *a):
        if text.startswith("CREATE TABLE"):
            raise RuntimeError("lost")
        return run(self, text, *a)

    with patch.object(type(spark), "sql", fail), pytest.raises(RuntimeError):
        sinks.write_table(spark.range(3), table)
    assert versions.tidy(spark, table) == []
    assert len(folders(spark, table)) == 3
    sinks.write_table(spark.range(2), table)
    assert spark.table(table).count() == 2


def test_tables_made_empty_before_are_replaced_too(spark, space):
    spark.sql(f"CREATE TABLE {space}.t (id bigint) USING parquet")
    sinks.write_table(spark.range(5), f"{space}.t")
    assert spark.table(f"{space}.t").count() == 5
    assert versions.is_version(versions.entry(spark, f"{space}.t").location)


# --- buckets ------------------------------------------------------------------------


def bronze(spark, root, hot_order=False):
    market = Market(spark, FOLDER)
    for entity in [*layers.SILVER, schemas.TRANSLATION]:
        df = market.translation() if entity == schemas.TRANSLATION else getattr(market, entity)()
        if hot_order and entity == "order_items":
            # a third of all items belong to one order
            order = silver.orders(market.orders()).agg(F.min("order_id")).first()[0]
            df = df.withColumn("order_id", F.when(F.col("order_item_id") % 3 == 1, order).otherwise(F.col("order_id")))
        sinks.write_parquet(df, f"{root}/{entity}")


def dropped(spark):
    for layer in ("silver", "gold"):
        spark.sql(f"DROP NAMESPACE IF EXISTS {layer} CASCADE")


FACTS = ["fact_sales", "fact_reviews", "fact_shipping"]


@pytest.fixture
def clean(spark):
    """The layers of other tests are set aside: these tests make them anew."""
    dropped(spark)
    yield
    dropped(spark)


@pytest.mark.parametrize("hot_order", [False, True])
def test_facts_from_buckets_are_the_same(spark, tmp_path, conf, clean, hot_order):
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    bronze(spark, str(tmp_path), hot_order)
    found = []
    for buckets in (0, 8):
        lake = layers.Lake(spark, str(tmp_path), buckets=buckets)
        layers.run_silver(lake)
        layers.run_dimensions(lake, queries.FIRST_DAY, queries.LAST_DAY)
        layers.run_facts(lake)
        found.append({fact: rows(lake.table("gold", fact)) for fact in FACTS})
    assert found[0] == found[1] and found[0]["fact_sales"]
    entry = versions.entry(spark, lake.name("silver", "order_items"))
    assert entry.buckets == Buckets(8, ("order_id",))
    assert len(lake.table("silver", "order_items").inputFiles()) >= 7

    header = lake.table("silver", "orders").join(
        lake.table("silver", "order_payments").groupBy("order_id").agg(F.sum("payment_value")), "order_id", "left"
    )
    plan = executed_plan(layers.sold_items(lake, header))
    if not hot_order:  # neither items nor orders nor payments are shuffled
        assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2
    else:  # the hot order's items are read in other tasks than those of its bucket
        assert "Union" in plan and "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    # the header as it is in a run meets the items where they lie
    full = gold_header(lake)
    plan = layers.sold_items(lake, full)._jdf.queryExecution().executedPlan().toString()
    scan = plan.index("FileScan", plan.index("price"))
    assert "Bucketed: true" in plan[scan : scan + 900]


def gold_header(lake):
    names = ["orders", "customers", "order_payments", "geolocation"]
    orders, customers, payments, places = (lake.table("silver", n) for n in names)
    return gold.order_header(orders, customers, lake.table("gold", "dim_customers"), payments, places)


# --- resumed runs -------------------------------------------------------------------


class Broken(Exception):
    pass


def test_a_broken_run_goes_on_where_it_stopped(spark, tmp_path, clean):
    """Broken before each table in turn: every table is written once, and all are right."""
    root = str(tmp_path)
    bronze(spark, root)
    lake = layers.Lake(spark, root, resume=True)
    write, written = layers.write_table, []
    allowed = [0]

    def once(df, table, *rest):
        if allowed[0] == 0:
            raise Broken(table)
        allowed[0] -= 1
        written.append(table.split(".", 1)[1])
        write(df, table, *rest)

    days = (queries.FIRST_DAY, queries.LAST_DAY)
    with patch.object(layers, "write_table", once):
        for _ in range(40):
            allowed[0] = 1
            try:
                layers.run_all(lake, *days)
                break
            except Broken:
                pass
        assert len(written) == len(set(written)) == 17
        # nothing to do
        layers.run_all(lake, *days)
        assert len(written) == 17
        # one input is new: what depends on it is made anew, and nothing else
        allowed[0] = 99
        written.clear()
        sinks.write_parquet(Market(spark, FOLDER).order_reviews().where("review_score > 1"), f"{root}/order_reviews")
        layers.run_all(lake, *days)
        assert written == ["silver.order_reviews", "gold.fact_reviews", f"gold.{schemas.RESPONSES}"]
        # other options
        written.clear()
        layers.run_all(lake, queries.FIRST_DAY, queries.FIRST_DAY)
        assert written == ["gold.dim_date", f"gold.{schemas.SEGMENTS}"]
        # other code
        written.clear()
        with patch.object(manifest, "code_state", lambda: "other"):
            layers.run_silver(lake)
        assert len(written) == 8
    resumed = {t: rows(lake.table("gold", t)) for t in [*FACTS, "dim_customers"]}
    plain = layers.Lake(spark, root)
    layers.run_silver(plain)
    layers.run_gold(plain, *days)
    assert {t: rows(plain.table("gold", t)) for t in resumed} == resumed


def test_a_note_holds_for_its_version_only(spark, tmp_path, clean):
    """Rows written by others, or by a run that broke off before its note, are not current."""
    bronze(spark, str(tmp_path))
    lake = layers.Lake(spark, str(tmp_path), resume=True)
    table = ("silver", "sellers")
    made = lambda: lake.make(*table, ["bronze.sellers"], lambda: layers.SILVER["sellers"](lake))
    assert made() and not made()
    lake.write(lake.bronze("sellers"), *table)
    assert made() and not made()
    with patch.object(manifest, "note", side_effect=Broken), pytest.raises(Broken):
        lake.write(lake.bronze("sellers"), *table)
        made()
    assert made() and not made()
