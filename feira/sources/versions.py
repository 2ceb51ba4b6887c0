"""Tables of the built-in catalog, replaced in one step.

Each write goes to a folder of its own, ``<database>/_versions/<table>/<number>-<id>``. Only when
all rows are there is the table's entry in the catalog switched to that folder, by one change of
its location. Until then, and if the write fails, readers get the old rows; a reader that was
opened before the switch finishes on the old folder, which stays until later writes.

A folder with a number above the current one belongs to a write that did not come to its switch,
and is removed by the next write. One writer at a time is assumed for each table.

A table whose columns or buckets change gets a new entry: the old one is dropped and the new one
created, so there is a moment without a table, but never without the rows: folders of versions are
not the catalog's to delete.
"""

import re
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

# Versions before the current one that stay, for readers that are still at work.
KEPT = 1

_VERSION = re.compile(r"(\d{8})-[0-9a-f]{8}")


class Buckets(NamedTuple):
    """Rows are dealt to ``count`` buckets by ``columns``."""

    count: int
    columns: tuple[str, ...]


class Entry(NamedTuple):
    """What the catalog says of a table."""

    location: str
    provider: str
    columns: tuple[tuple[str, str], ...]
    buckets: Buckets | None


def entry(spark: SparkSession, table: str) -> Entry | None:
    """The table's entry in the catalog, if it has one."""
    if not spark.catalog.tableExists(table):
        return None
    details, columns, section = {}, [], "columns"
    for name, value, _ in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
        if name.startswith("#"):
            section = name
        elif section == "columns" and name:
            columns.append((name, value))
        elif section == "# Detailed Table Information":
            details[name] = value
    number = int(details.get("Num Buckets", "0"))
    keys = tuple(re.findall(r"`([^`]+)`", details.get("Bucket Columns", "")))
    buckets = Buckets(number, keys) if number > 0 else None
    return Entry(details.get("Location", ""), details.get("Provider", "").lower(), tuple(columns), buckets)


def _versions_folder(spark: SparkSession, table: str) -> str:
    database, _, name = table.rpartition(".")
    if database:
        root = spark.catalog.getDatabase(database).locationUri
    else:
        root = spark.catalog.getDatabase(spark.catalog.currentDatabase()).locationUri
    return f"{root.rstrip('/')}/_versions/{name}"


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def versions(spark: SparkSession, table: str) -> list[str]:
    """Folders of versions that are there, oldest first, switched to or not."""
    folder = _versions_folder(spark, table)
    files, path = _file_system(spark, folder)
    if not files.exists(path):
        return []
    names = [status.getPath().getName() for status in files.listStatus(path)]
    return [f"{folder}/{name}" for name in sorted(names) if _VERSION.fullmatch(name)]


def _number(location: str) -> int:
    """The number of a version's folder; 0 for any other folder."""
    found = _VERSION.fullmatch(location.rstrip("/").rsplit("/", 1)[-1])
    return int(found[1]) if found else 0


def is_version(location: str) -> bool:
    """Whether a location is a version's folder, whose name no other version ever has."""
    return _number(location) > 0


def tidy(spark: SparkSession, table: str, kept: int = KEPT) -> list[str]:
    """Remove what broken writes left, and versions older than the ``kept`` last ones.

    Without an entry nothing is removed: a change of columns may have broken off half-way.
    """
    now = entry(spark, table)
    if now is None:
        return []
    current, there = _number(now.location), versions(spark, table)
    unfinished = [v for v in there if _number(v) > current]
    older = [v for v in there if _number(v) < current]
    removed = unfinished + older[: max(0, len(older) - kept)]
    for folder in removed:
        files, path = _file_system(spark, folder)
        files.delete(path, True)
    return removed


def _write(df: DataFrame, path: str, table: str, table_format: str, buckets: Buckets | None) -> None:
    if buckets is None:
        df.write.format(table_format).save(path)
        return
    # files in buckets are only written for tables: an entry for as long as the write takes
    spark = df.sparkSession
    database, dot, name = table.rpartition(".")
    passing = f"{database}{dot}writing_{name}_{path.rsplit('-', 1)[-1]}"
    writer = df.write.format(table_format).option("path", path)
    try:
        writer.bucketBy(buckets.count, *buckets.columns).sortBy(*buckets.columns).saveAsTable(passing)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {passing}")


def _columns(df: DataFrame) -> tuple[tuple[str, str], ...]:
    return tuple((f.name, f.dataType.simpleString()) for f in df.schema.fields)


def switch(
    spark: SparkSession, table: str, path: str, df: DataFrame, table_format: str, buckets: Buckets | None
) -> None:
    """Make the version at ``path``, with the columns of ``df``, the table's rows."""
    now = entry(spark, table)
    if now and (now.provider, now.columns, now.buckets) == (table_format.lower(), _columns(df), buckets):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    else:
        if now:
            spark.sql(f"DROP TABLE {table}")
        ddl = df._jdf.schema().toDDL()
        keys = ", ".join(f"`{name}`" for name in buckets.columns) if buckets else ""
        dealt = f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets.count} BUCKETS" if buckets else ""
        spark.sql(f"CREATE TABLE {table} ({ddl}) USING {table_format} {dealt} LOCATION '{path}'")
    spark.catalog.refreshTable(table)


def replace(
    df: DataFrame, table: str, table_format: str = "parquet", buckets: Buckets | None = None, kept: int = KEPT
) -> str:
    """Replace all rows of ``table``, and its columns, by ``df``; returns the new folder."""
    spark = df.sparkSession
    tidy(spark, table, kept)
    now = entry(spark, table)
    taken = [now.location] if now else versions(spark, table)
    number = max(map(_number, taken), default=0) + 1
    path = f"{_versions_folder(spark, table)}/{number:08d}-{uuid.uuid4().hex[:8]}"
    _write(df, path, table, table_format, buckets)
    switch(spark, table, path, df, table_format, buckets)
    tidy(spark, table, kept)
    return path
