"""Writing Parquet folders, CSV exports and catalog tables."""

from collections.abc import Mapping
from urllib.parse import unquote, urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import partitioning

from feira import schemas
from feira.sources import versions
from feira.sources.versions import Buckets

SESSION_CATALOG = "spark_catalog"
ICEBERG_PROPERTIES = {"format-version": "2"}


def _roots(df: DataFrame) -> list[str]:
    """The folders and files that the plan's scans were opened with, not their contents."""
    roots, pending = [], [df._jdf.queryExecution().analyzed()]
    while pending:
        node = pending.pop()
        if node.nodeName() == "LogicalRelation":
            relation = node.relation()
            if relation.getClass().getSimpleName() == "HadoopFsRelation":
                paths = relation.location().rootPaths()
                roots += [paths.apply(i).toString() for i in range(paths.size())]
        children = node.children()
        pending += [children.apply(i) for i in range(children.size())]
        inner = node.innerChildren() if node.nodeName() == "InMemoryRelation" else None
        pending += [inner.apply(i) for i in range(inner.size())] if inner else []
    return roots


def _reads_from(df: DataFrame, path: str) -> bool:
    """Whether ``df`` scans the folder ``path``, something in it or a folder around it.

    Looks at the paths in the plan only. A path without a scheme is compared without
    one, so it may match too much.
    """
    target = urlparse(path)
    folder = f"/{target.path.strip('/')}/"
    for name in _roots(df):
        source = urlparse(name)
        same_store = not target.scheme or (source.scheme, source.netloc) == target[:2]
        root = f"/{unquote(source.path).strip('/')}/"
        if same_store and (root.startswith(folder) or folder.startswith(root)):
            return True
    return False


def _refuse_own_input(df: DataFrame, path: str) -> None:
    if _reads_from(df, path):
        raise ValueError(f"{path} is also being read from")


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace a folder. Overwriting deletes first, so reading the same folder is refused."""
    _refuse_own_input(df, path)
    df.write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV part files with headers, written by the tasks that hold the rows.

    Quotes are doubled, outer spaces kept, null is nothing and the empty text a pair of
    quotes, so that ``exports.read_csv`` can give the same values back.
    """
    _refuse_own_input(df, path)
    df.write.mode("overwrite").csv(
        path,
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def can_replace(spark: SparkSession, table: str) -> bool:
    """Whether the table's catalog is a plug-in one, which can replace tables atomically.

    Spark's built-in session catalog cannot; there, writes go through ``versions``.
    """
    parts = table.split(".")
    catalog = parts[0] if len(parts) > 2 else SESSION_CATALOG
    plugin = spark.conf.get(f"spark.sql.catalog.{catalog}", "")
    return plugin not in ("", "builtin")


def write_table(
    df: DataFrame,
    table: str,
    table_format: str = "parquet",
    properties: Mapping[str, str] | None = None,
    buckets: Buckets | None = None,
) -> None:
    """Replace all rows and the schema of a named table, in buckets if asked for.

    Readers get the old rows until all new ones are there: in a plug-in catalog (Iceberg and
    the like) by its own means, in the session catalog by a folder for each version and a
    switch of the table's location (``versions``). A table that ``df`` reads is refused.
    """
    spark = df.sparkSession
    if can_replace(spark, table):
        writer = df.writeTo(table).using(table_format)
        for key, value in (properties or {}).items():
            writer = writer.tableProperty(key, value)
        if buckets:
            writer = writer.partitionedBy(*[partitioning.bucket(buckets.count, c) for c in buckets.columns])
        writer.createOrReplace()
        return
    now = versions.entry(spark, table)
    if now and now.location and _reads_from(df, now.location):
        raise AnalysisException(f"{table} is also being read from")
    versions.replace(df, table, table_format, buckets)


def create_tables(
    spark: SparkSession,
    catalog: str = SESSION_CATALOG,
    table_format: str = "parquet",
    layers: Mapping[str, Mapping[str, str]] = schemas.LAYERS,
) -> list[str]:
    """Create the namespaces and empty typed tables that do not exist yet."""
    names = []
    for layer, tables in layers.items():
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {catalog}.{layer}")
        for table, ddl in tables.items():
            name = f"{catalog}.{layer}.{table}"
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING {table_format}")
            names.append(name)
    return names
