"""What several operators share: shipping the package, working tables, texts out of Arrow."""

import io
import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.sources.working import new_folder

# A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
# Rows of a side that may be sent to every executor: with the widest rows here (a digest of
# 64 characters and a few numbers) about 50 MB. Larger sides are joined by a shuffle.
BROADCAST_ROWS = 400_000

_SHIPPED = "feira.shipped"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that their Python finds it."""
    context = spark.sparkContext
    if context.getLocalProperty(_SHIPPED) == context.applicationId:
        return
    root = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, str(file.relative_to(root.parent)))
    path = os.path.join(tempfile.mkdtemp(prefix="feira-"), f"{root.name}.zip")
    Path(path).write_bytes(packed.getvalue())
    context.addPyFile(path)
    context.setLocalProperty(_SHIPPED, context.applicationId)


def stored(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Write as Parquet in the shared folder and read back: what follows survives lost executors."""
    path = f"{folder or new_folder(df.sparkSession)}/{label}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, marked for broadcast if it has few rows. ``df`` should be stored: it is counted."""
    return F.broadcast(df) if df.count() <= rows else df


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def sliced(batches: Iterator[pa.RecordBatch], size: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text, or one row if it is longer."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64) // size
        cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:], strict=False):
            if end > begin:
                yield batch.slice(begin, end - begin)


def texts(column: pa.Array) -> Iterator[str]:
    """The strings of an Arrow column one by one, null as the empty string."""
    for value in column:
        yield value.as_py() or ""


def byte_texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of an Arrow column one by one, null as no bytes."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""
