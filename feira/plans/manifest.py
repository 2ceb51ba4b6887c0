"""What each table was made from, so that a run that broke off goes on where it stopped.

After a table has been switched to its new rows, a digest of everything that they come from is
noted in the table's properties: the files of bronze inputs (paths, sizes, times), the versions of
input tables, the options and the code of this library; and with it the version that it holds for.
A table is current if the digest noted is that of today's inputs and its rows are still those.

A run that breaks off before the note is written makes the table once more. Tables without versions
of their own, as in a plug-in catalog, are never taken as current.
"""

import hashlib
import json
from collections.abc import Mapping
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.sources import versions

PROPERTY = "feira.made_from"


@cache
def code_state() -> str:
    """A digest of the code that tables are made by: this package without its subpackage of
    operators that no table is made with."""
    root = Path(__file__).resolve().parents[1]
    found = hashlib.sha256()
    for file in sorted(root.rglob("*.py")):
        if "llm" not in file.relative_to(root).parts:
            found.update(str(file.relative_to(root)).encode() + b"\0" + file.read_bytes())
    return found.hexdigest()


def folder_state(spark: SparkSession, folder: str) -> str:
    """The files of a folder as one line, whatever their number: no file is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = reader.load(folder).select("path", "length", "modificationTime")
    each = F.xxhash64("path", "length", "modificationTime")
    state: DataFrame = files.agg(
        F.count("*"), F.sum("length"), F.max("modificationTime").cast("string"),
        F.bit_xor(each), F.sum(each.cast("decimal(38,0)")).cast("string"),
    )
    return json.dumps(list(state.first()))


def table_state(spark: SparkSession, table: str) -> str | None:
    """Which version a table holds; none if it has no versions of its own."""
    entry = versions.entry(spark, table)
    return entry.location if entry and versions.is_version(entry.location) else None


def digest(inputs: Mapping[str, str | None], options: Mapping[str, object]) -> str | None:
    """One digest of all that rows come from; none if an input cannot be told from another."""
    if None in inputs.values():
        return None
    state = [sorted(inputs.items()), sorted((k, str(v)) for k, v in options.items()), code_state()]
    return hashlib.sha256(json.dumps(state).encode()).hexdigest()


def _noted(spark: SparkSession, table: str) -> str | None:
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == PROPERTY).first()
    return found["value"] if found else None


def is_current(spark: SparkSession, table: str, made_from: str | None) -> bool:
    if made_from is None or not spark.catalog.tableExists(table):
        return False
    now = table_state(spark, table)
    return now is not None and _noted(spark, table) == f"{made_from}@{now}"


def note(spark: SparkSession, table: str, made_from: str) -> None:
    now = table_state(spark, table)
    if now is not None:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PROPERTY}' = '{made_from}@{now}')")
