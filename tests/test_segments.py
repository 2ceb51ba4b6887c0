import subprocess
import sys
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from tests.conftest import executed_plan, rows
from pyspark.sql import functions as F

from feira import schemas
from feira.plans import gold, segments


@pytest.fixture
def stars(spark, frame):
    def sale(key, customer, day, paid):
        return (key, customer, "p", "s", day, Decimal(1), Decimal(0), paid, 1, 0)

    sales = frame(
        schemas.GOLD["fact_sales"],
        sale("a", "k1", "20170101", Decimal("30.00")),
        sale("b", "k1", "20170105", Decimal("5.50")),
        sale("c", "k2", "20170110", None),
        sale("d", None, "20170120", Decimal("9.00")),
        sale("e", "k1", "20990101", Decimal("9.00")),
        sale("f", "k9", "20170121", Decimal("9.00")),
    )
    customers = frame(
        schemas.GOLD["dim_customers"],
        ("k1", "u1", 1, "rio", "RJ"),
        ("k2", "u2", 1, "natal", "RN"),
        ("k3", "u3", 1, "natal", "RN"),
    )
    return sales, gold.dim_date(spark), customers


def test_rfm_features(stars):
    """Sales without a known customer or day do not count, nor set the newest day."""
    features = segments.rfm_features(segments.rfm_totals(*stars))
    assert rows(features) == [
        ("u1", "rio", "RJ", 6, 2, Decimal("35.50")),
        ("u2", "natal", "RN", 1, 1, Decimal("0.00")),
    ]


def test_sums_equal_those_of_the_sales(stars):
    sales, dates, customers = stars
    joined = sales.join(dates, "date_key").join(customers, "customer_key")
    direct = joined.agg(F.count("sale_key"), F.sum("payment_value")).first()
    features = segments.rfm_features(segments.rfm_totals(*stars))
    assert features.agg(F.sum("Frequency"), F.sum("Monetary")).first() == direct


def test_sales_are_reduced_before_customers_are_joined(stars, conf):
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    plan = segments.rfm_totals(*stars)._jdf.queryExecution().executedPlan().toString()
    join = plan.index("SortMergeJoin [customer_key")
    assert "partial_sum(payment_value" in plan[join:]


def test_no_nested_loop_for_the_newest_day(stars):
    plan = executed_plan(segments.rfm_features(segments.rfm_totals(*stars)))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_rfm_of_nothing(stars):
    sales, dates, customers = stars
    totals = segments.rfm_totals(sales.filter("false"), dates, customers)
    features = segments.rfm_features(totals)
    assert rows(features) == []
    assert rows(segments.segment(features)) == []
    assert segments.segment(features).columns == [*features.columns, "Cluster"]


def people(spark, count=400):
    """Four well separated groups of equal size."""
    group = F.col("id") % 4
    return spark.range(count).select(
        F.concat(F.lit("u"), F.col("id").cast("string")).alias("customer_unique_id"),
        F.lit("rio").alias("customer_city"),
        F.lit("RJ").alias("customer_state"),
        (group * 100 + F.col("id") % 3).cast("int").alias("Recency"),
        (group * 20 + F.col("id") % 5).alias("Frequency"),
        (group * 1000 + F.col("id") % 7).cast("decimal(38,2)").alias("Monetary"),
    )


def test_segment_finds_separate_groups(spark):
    clustered = segments.segment(people(spark))
    declared = schemas.struct(schemas.DERIVED[schemas.SEGMENTS])
    assert [(f.name, f.dataType) for f in clustered.schema] == [
        (f.name, f.dataType) for f in declared
    ]
    groups = clustered.groupBy("Cluster").agg(
        F.count("*").alias("n"), F.min("Monetary").alias("least")
    )
    found = sorted(tuple(row) for row in groups.collect())
    assert [row[:2] for row in found] == [(0, 100), (1, 100), (2, 100), (3, 100)]
    assert [row[2] for row in found] == [0, 1000, 2000, 3000]


def test_segment_does_not_depend_on_input_layout(spark):
    df = people(spark)
    expected = rows(segments.segment(df))
    for partitions in (1, 3, 7):
        assert rows(segments.segment(df.repartition(partitions))) == expected


LABELS = """
import sys, hashlib
from pyspark.sql import SparkSession, functions as F
from feira.plans import segments
master, split, path, work = sys.argv[1:]
spark = (
    SparkSession.builder.master(master)
    .config("spark.sql.files.maxPartitionBytes", split)
    .config("spark.sql.shuffle.partitions", "3" if master == "local[2]" else "5")
    .config("spark.ui.enabled", "false")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
found = segments.segment(spark.read.parquet(path), folder=work).orderBy("customer_unique_id")
rows = [(row.customer_unique_id, row.Cluster) for row in found.collect()]
print("LABELS", len(rows), hashlib.sha256(repr(rows).encode()).hexdigest())
"""


def test_labels_do_not_depend_on_cores_or_splits(spark, tmp_path):
    """People without clear groups, in a process of its own for each number of cores."""
    spread = spark.range(4000).select(
        F.concat(F.lit("u"), F.col("id").cast("string")).alias("customer_unique_id"),
        F.lit("rio").alias("customer_city"),
        F.lit("RJ").alias("customer_state"),
        (F.rand(1) * 900).cast("int").alias("Recency"),
        (F.rand(2) * 50).cast("long").alias("Frequency"),
        (F.rand(3) * 1000).cast("decimal(38,2)").alias("Monetary"),
    )
    path = str(tmp_path / "features")
    spread.write.parquet(path)
    found = set()
    for i, (master, split) in enumerate(
        [("local[1]", "128m"), ("local[2]", "128m"), ("local[4]", "128m"), ("local[2]", "8k")]
    ):
        arguments = [master, split, path, str(tmp_path / f"work{i}")]
        run = subprocess.run(
            [sys.executable, "-c", LABELS, *arguments],
            cwd=Path(__file__).parent.parent,
            capture_output=True,
            text=True,
            timeout=300,
        )
        found.add(next(line for line in run.stdout.splitlines() if line.startswith("LABELS 4000")))
    assert len(found) == 1


def test_checks_of_a_fit(spark):
    checked = segments.checked_segments(people(spark))
    assert checked.where("in_range and is_nearest and centres_in_order").count() == 400


def test_segment_of_fewer_rows_than_clusters(spark):
    clustered = segments.segment(people(spark, 2))
    assert clustered.count() == 2
    assert clustered.filter("Cluster is null or Cluster not between 0 and 3").count() == 0


def test_segment_beats_one_global_centre(spark):
    scaled = segments.standardise(people(spark).withColumn("Monetary", F.col("Monetary") + 1))
    clustered = segments.segment(people(spark))
    assert scaled.count() == clustered.count()
    spread = clustered.groupBy("Cluster").agg(
        F.var_pop("Monetary").alias("v"), F.count("*").alias("n")
    )
    within = spread.agg(F.sum(F.col("v") * F.col("n"))).first()[0]
    overall = clustered.agg(F.var_pop("Monetary") * F.count("*")).first()[0]
    assert within < overall


def test_standardise(spark):
    columns = [f"{name}_z" for name in segments.FEATURES]
    scaled = segments.scaled_columns(people(spark))
    stats = scaled.agg(
        *[F.avg(c) for c in columns], *[F.stddev_samp(c) for c in columns]
    ).first()
    assert list(stats) == pytest.approx([0, 0, 0, 1, 1, 1], abs=1e-9)


def test_recency_is_from_the_day_after(stars):
    features = segments.rfm_features(segments.rfm_totals(*stars))
    assert features.agg(F.min("Recency")).first()[0] == 1
    assert date(2017, 1, 11).toordinal() - date(2017, 1, 5).toordinal() == 6
