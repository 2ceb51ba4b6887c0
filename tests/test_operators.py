import random

from tests.conftest import executed_plan, rows
from pyspark.sql import functions as F

from feira.operators import (
    assign_nearest,
    distinct_rows,
    keep_first,
    orphans,
    row_audit,
    translate_or_keep,
)

DDL = "k string, a int, b string"
COPIES = [
    ("x", 2, "p"),
    ("x", 1, "q"),
    ("x", 1, "p"),
    ("y", None, "z"),
    ("y", 0, "a"),
    (None, 5, "n"),
    (None, 4, "n"),
]
FIRST = sorted([("x", 1, "p"), ("y", None, "z"), (None, 4, "n")], key=repr)


def test_keep_first_takes_the_smallest_row_nulls_first(frame):
    assert rows(keep_first(frame(DDL, *COPIES), "k")) == FIRST


def test_keep_first_does_not_depend_on_layout(frame):
    for seed in range(4):
        shuffled = random.Random(seed).sample(COPIES, len(COPIES))
        df = frame(DDL, *shuffled).repartition(seed + 1)
        assert rows(keep_first(df, "k")) == FIRST


def test_keep_first_keeps_column_order_and_types(frame):
    df = frame("a int, k string, b string", (1, "x", "p"))
    assert keep_first(df, "k").schema == df.schema


def test_keep_first_of_key_only(frame):
    assert rows(keep_first(frame("k string", ("x",), ("x",)), "k")) == [("x",)]


def test_keep_first_with_two_keys(frame):
    df = frame("k string, l int, a int", ("x", 1, 9), ("x", 1, 8), ("x", 2, 7))
    assert rows(keep_first(df, "k", "l")) == [("x", 1, 8), ("x", 2, 7)]


def test_keep_first_shuffles_once_and_combines_before(spark):
    df = spark.range(1000).select((F.col("id") % 3).cast("string").alias("k"), "id")
    plan = executed_plan(keep_first(df, "k"))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_min" in plan


def test_distinct_rows_equals_distinct(frame):
    df = frame(DDL, *COPIES, *COPIES)
    assert rows(distinct_rows(df)) == rows(df.distinct()) == sorted(COPIES, key=repr)
    assert distinct_rows(df).columns == df.columns


def test_distinct_rows_shuffles_by_the_row_after_a_join(spark, conf):
    conf(autoBroadcastJoinThreshold="-1")
    left = spark.range(100).select("id", (F.col("id") % 7).alias("a"))
    joined = left.join(spark.range(50), "id")
    assert executed_plan(joined.distinct()).count("Exchange hashpartitioning") == 2
    assert executed_plan(distinct_rows(joined)).count("Exchange hashpartitioning") == 3


def test_translate_or_keep(frame):
    df = frame("id int, c string", (1, "a"), (2, "b"), (3, None))
    lookup = frame("c string, e string, other int", ("a", "A", 1), ("b", None, 2))
    result = translate_or_keep(df, lookup, "c", "e")
    assert result.columns == ["id", "c"]
    assert rows(result) == [(1, "A"), (2, "b"), (3, None)]


def test_translate_repeats_rows_for_repeated_keys(frame):
    df = frame("id int, c string", (1, "a"))
    lookup = frame("c string, e string", ("a", "A"), ("a", "B"))
    assert rows(translate_or_keep(df, lookup, "c", "e")) == [(1, "A"), (1, "B")]


def test_assign_nearest(frame):
    df = frame("x double, y double", (0.0, 0.1), (5.0, 5.0), (1.0, 0.0))
    result = assign_nearest(df, ["x", "y"], [(0, 0), (2, 0), (5, 6)])
    assert rows(result) == [(0.0, 0.1, 0), (1.0, 0.0, 0), (5.0, 5.0, 2)]


def test_row_audit(frame):
    before = frame("a int", (1,), (2,), (3,))
    empty = before.filter("a > 9")
    result = row_audit({"t": (before, before.filter("a > 1")), "none": (empty, empty)})
    assert rows(result) == [("none", 0, 0, 0), ("t", 3, 2, 1)]


def test_orphans_counts_rows_and_keys_and_nulls(frame):
    child = frame("k string", ("a",), ("b",), ("b",), (None,), (None,))
    parent = frame("k string, v int", ("a", 1), (None, 2))
    result = orphans([("child", child, "parent", parent, "k")])
    assert rows(result) == [("child", "parent", "k", 4, 2)]


def test_orphans_of_complete_link_is_zero(frame):
    table = frame("k string", ("a",))
    assert rows(orphans([("c", table, "p", table, "k")])) == [("c", "p", "k", 0, 0)]
