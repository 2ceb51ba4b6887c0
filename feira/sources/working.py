"""Working storage for results that several later jobs read."""

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    Where it is unset, a local session, which has no other machines, gets one in its
    warehouse; on a cluster it has to be set.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local["):
        return f"{spark.conf.get(WAREHOUSE_DIR).rstrip('/')}/_working"
    raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors can reach")


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Uses the driver's Hadoop file systems, so it needs a classic session, not Connect."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _delete_at_exit(spark: SparkSession, folder: str) -> None:
    with suppress(Exception):  # the JVM may be gone already
        delete_folder(spark, folder)


def new_folder(spark: SparkSession) -> str:
    """A folder of its own inside the shared one, deleted when this Python ends, or when the
    ``scope`` around the call does.

    For results that are read lazily after the call that stored them.
    """
    folder = f"{shared_folder(spark)}/feira-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(folder)
    else:
        atexit.register(_delete_at_exit, spark, folder)
    return folder


# Folders of the scopes that are open, the innermost last.
_scopes: list[list[str]] = []


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Folders that operators open inside the block are deleted at its end.

    For sessions that call many operators one after the other: what they return is read lazily
    from these folders, so it has to be written before the block ends. Not for several threads.
    """
    folders: list[str] = []
    _scopes.append(folders)
    try:
        yield
    finally:
        _scopes.pop()
        for folder in folders:
            delete_folder(spark, folder)


@contextmanager
def working_folder(spark: SparkSession) -> Iterator[str]:
    """A folder of its own inside the shared one, deleted when the block ends."""
    folder = f"{shared_folder(spark)}/feira-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        delete_folder(spark, folder)


def store(df: DataFrame, label: str, folder: str) -> DataFrame:
    """Write once as Parquet, in ``folder``, and read back.

    Cuts the lineage: later jobs do not recompute the input when an executor is lost,
    and each reads only the columns it needs.
    """
    path = f"{folder}/{label}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
