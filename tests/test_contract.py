import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira import schemas
from feira.plans import layers
from feira.sources import contract, exports, versions
from feira.sources.contract import Change, Kind
from tests.test_layers import bronze_frames


def kinds(frame, declared):
    found = contract.changes(T.StructType.fromDDL(frame), T.StructType.fromDDL(declared))
    return [(change.kind, change.column) for change in found]


@pytest.mark.parametrize(
    ("frame", "declared", "expected"),
    [
        ("a int, b string", "a int, b string", []),
        ("a int", "a bigint", [(Kind.WIDENED, "a")]),
        ("a bigint", "a int", [(Kind.NARROWED, "a")]),
        ("a decimal(17,4)", "a decimal(18,2)", [(Kind.NARROWED, "a")]),
        ("a decimal(18,2)", "a decimal(28,2)", [(Kind.WIDENED, "a")]),
        ("a decimal(20,2)", "a decimal(20,4)", [(Kind.NARROWED, "a")]),
        ("a int", "a decimal(12,2)", [(Kind.WIDENED, "a")]),
        ("a int", "a decimal(11,2)", [(Kind.NARROWED, "a")]),
        ("a bigint", "a double", [(Kind.NARROWED, "a")]),
        ("a int", "a double", [(Kind.WIDENED, "a")]),
        ("a float", "a double", [(Kind.WIDENED, "a")]),
        ("a string", "a int", [(Kind.OTHER_TYPE, "a")]),
        ("a timestamp", "a date", [(Kind.OTHER_TYPE, "a")]),
        ("a int", "a int not null", [(Kind.MAY_BE_NULL, "a")]),
        ("a int not null", "a int", []),
        ("a int", "a int, b string", [(Kind.MISSING, "b")]),
        ("a int, c string", "a int, b string", [(Kind.RENAMED, "b")]),
        ("a int, b string, c string", "a int, b string", [(Kind.UNDECLARED, "c")]),
        ("b string, a int", "a int, b string", [(Kind.MOVED, "b, a")]),
        ("a int, a int", "a int", [(Kind.OTHER_TYPE, "a")]),
        ("a array<int>", "a array<bigint>", [(Kind.WIDENED, "a")]),
        ("a struct<x:int>", "a struct<x:bigint>", [(Kind.WIDENED, "a")]),
        ("a struct<x:int>", "a struct<y:int>", [(Kind.OTHER_TYPE, "a")]),
    ],
)
def test_changes(frame, declared, expected):
    assert kinds(frame, declared) == expected


def test_harmless_changes_are_brought_to_the_declared_form(frame):
    declared = T.StructType.fromDDL("a bigint, b decimal(12,2)")
    found = contract.conform(frame("b int, a int", (1, 2)), declared, "t")
    assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in declared]
    assert [tuple(map(str, row)) for row in found.collect()] == [("2", "1.00")]


def test_narrowing_is_refused_before_any_row_is_read(spark, tmp_path):
    """The frame would fail as soon as one of its rows were made."""
    failing = spark.range(3).select(F.raise_error(F.lit("read")).cast("bigint").alias("seller_zip_code_prefix"))
    whole = failing.select(F.lit("s").alias("seller_id"), "*", F.lit("c").alias("seller_city"), F.lit("x").alias("seller_state"))
    lake = layers.Lake(spark, str(tmp_path), strict=True)
    before = versions.entry(spark, lake.name("silver", "sellers"))
    with pytest.raises(AnalysisException, match="seller_zip_code_prefix: narrowed .bigint for int"):
        lake.write(whole, "silver", "sellers")
    assert versions.entry(spark, lake.name("silver", "sellers")) == before
    assert str(Change(Kind.MISSING, "x")) == "x: missing"


def test_whole_runs_are_as_declared(spark, tmp_path):
    """From CSV exports, whose types are the declared ones, every table of every layer passes."""
    folder = tmp_path / "exports"
    folder.mkdir()
    names = {schemas.TRANSLATION: f"{schemas.TRANSLATION}.csv"}
    for entity, df in bronze_frames(spark).items():
        text = df.select([F.col(c).cast("string") for c in df.columns]).toPandas()
        text.to_csv(folder / names.get(entity, f"shop_{entity}_dataset.csv"), index=False)
    root = str(tmp_path / "bronze")
    exports.ingest_folder(spark, str(folder), root)
    lake = layers.Lake(spark, root, strict=True)
    try:
        layers.run_all(lake)
        for layer, tables in {"silver": schemas.SILVER, "gold": schemas.GOLD | schemas.DERIVED}.items():
            for table, ddl in tables.items():
                found, declared = lake.table(layer, table).schema, schemas.struct(ddl)
                assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in declared], table
    finally:
        for layer in ("silver", "gold"):
            spark.sql(f"DROP NAMESPACE IF EXISTS {layer} CASCADE")
