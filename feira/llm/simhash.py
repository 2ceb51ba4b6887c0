"""Near-dedup: SimHash fingerprints, linked by covering locality-sensitive hashing.

Every bit position has a vector of r + 1 bits. For each vector v but zero, a mask keeps the
positions whose own vector has an odd scalar product with v. The vectors of the r or fewer
positions in which two fingerprints differ span at most r dimensions, so some v is orthogonal
to all of them, and under its mask the two are equal: with 2^(r+1) - 1 tables every pair
within radius r meets. Tables hold different fingerprints only, and of a bucket only the links
of a spanning forest leave the task.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.llm.common import byte_texts, read_documents, ship, sliced, small, stored
from feira.llm.components import components
from feira.sources.working import new_folder

SHINGLE_WORDS = 4
HASH_SEED = 42
RADIUS = 4
BITS = 64
# A bucket with more fingerprints is cut into parts, and all pairs of parts are compared as
# separate groups, so that no task holds more than two parts.
PART = 4096

ROW = "_feira_row"


def fingerprint(data: bytes) -> int:
    """SimHash of one text, as an unsigned number; 0 if it has no words."""
    words = data.lower().split()  # bytes: only A-Z, and only the six white-space characters
    if not words:
        return 0
    plain = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    size = min(SHINGLE_WORDS, len(words))
    starts = np.concatenate([[0], ends])[: len(words) - size + 1].tolist()
    stops = (ends[size - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(plain[i:j], HASH_SEED) for i, j in zip(starts, stops, strict=True)]
    return majority(np.array(hashes, np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes. Long lists are counted in parts."""
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > len(hashes)).tolist()))


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        values = np.array([fingerprint(data) for data in byte_texts(batch["text"])], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch["row"], batch["doc_id"], pa.array(values.view(np.int64))], ["row", "doc_id", "fp"]
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """row, doc_id and fp (the 64 bits as a signed number) of every document."""
    ship(docs.sparkSession)
    row = F.col(ROW) if ROW in docs.columns else F.monotonically_increasing_id()
    light = docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return light.mapInArrow(_fingerprint_batches, "row long, doc_id long, fp long")


def masks(radius: int = RADIUS) -> list[int]:
    """Covering masks. Position i has the vector (i mod (2^(r+1) - 1)) + 1: none is zero."""
    vectors = [i % ((1 << radius + 1) - 1) + 1 for i in range(BITS)]
    return [
        sum(1 << i for i, vector in enumerate(vectors) if (vector & v).bit_count() % 2)
        for v in range(1, 1 << radius + 1)
    ]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def forest(values: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links that connect what pairs within the radius connect, at most one per fingerprint.

    Reached fingerprints are compared with those not reached yet, so in a dense group there
    is little left to compare after a few steps.
    """
    links, rest = [], values
    while len(rest):
        waiting, rest = [rest[0]], rest[1:]
        while waiting and len(rest):
            current = waiting.pop()
            near = np.bitwise_count(rest ^ current) <= radius
            for other in rest[near].tolist():
                links.append((int(current), other))
            waiting.extend(rest[near])
            rest = rest[~near]
    return links


def _bucket_links(radius: int):
    def bucket_links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by bucket; a bucket may go on in the next batch."""
        carried, bucket = [], None
        found: list[tuple[int, int]] = []

        def close() -> None:
            if sum(map(len, carried)) > 1:
                found.extend(forest(np.concatenate(carried).astype(np.int64).view(np.uint64), radius))

        for frame in batches:
            keys = frame[["mask", "key", "part", "other"]].to_numpy()
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            values = frame["fp"].to_numpy()
            starts = np.concatenate([[0], cuts]) if len(values) else []
            for start, piece in zip(starts, np.split(values, cuts), strict=False):
                if (now := tuple(keys[start])) != bucket:
                    close()
                    carried, bucket = [], now
                carried.append(piece)
            if found:
                yield _frame(found)
                found = []
        close()
        if found:
            yield _frame(found)

    return bucket_links


def _frame(links: list[tuple[int, int]]) -> pd.DataFrame:
    return pd.DataFrame(np.array(links, np.uint64).view(np.int64).reshape(-1, 2), columns=["a", "b"])


def links(distinct: DataFrame, folder: str, radius: int = RADIUS) -> DataFrame:
    """Links between fingerprints (column fp, different and stored) within the radius.

    Pairs that are connected by pairs within the radius are connected by links, and every
    link is such a pair; not every pair is a link.
    """
    tables = F.array(*[F.struct(F.lit(i).alias("mask"), F.lit(_signed(m)).alias("bits")) for i, m in enumerate(masks(radius))])
    keyed = distinct.select("fp", F.explode(tables).alias("t")).select(
        "fp", F.col("t.mask").alias("mask"), F.col("fp").bitwiseAND(F.col("t.bits")).alias("key")
    )
    sizes = keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
    sizes = stored(sizes, "buckets", folder)
    members = keyed.join(small(sizes), ["mask", "key"])
    parts = F.ceil(F.col("n") / F.lit(PART)).cast("int")
    part = F.pmod(F.xxhash64("fp", "mask"), parts).cast("int")
    # a member of part p goes to the groups (p, q) and (q, p) with the smaller number first
    pairs = F.transform(
        F.sequence(F.lit(0), parts - 1),
        lambda q: F.struct(F.least(q, part).alias("part"), F.greatest(q, part).alias("other")),
    )
    dealt = members.select("fp", "mask", "key", F.explode(pairs).alias("p")).select(
        "fp", "mask", "key", "p.part", "p.other"
    )
    group = ["mask", "key", "part", "other"]
    sorted_groups = dealt.repartition(*group).sortWithinPartitions(*group, "fp")
    return sorted_groups.mapInPandas(_bucket_links(radius), "a long, b long").distinct()


def grouped(docs: DataFrame, folder: str, radius: int = RADIUS) -> DataFrame:
    """row, doc_id, fp, component (its smallest fingerprint) and component_id of every row."""
    light = stored(fingerprints(docs), "fingerprints", folder)
    distinct = stored(light.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct", folder)
    nodes = components(links(distinct.select("fp"), folder, radius), folder)
    nodes = stored(nodes, "components", folder)
    members = distinct.join(small(nodes), distinct["fp"] == nodes["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    members = stored(members, "members", folder)
    firsts = stored(
        members.groupBy("component").agg(F.min("first").alias("component_id")), "firsts", folder
    )
    owners = members.join(small(firsts), "component").select("fp", "component", "component_id")
    return light.join(small(stored(owners, "owners", folder)), "fp")


def near_groups(docs: DataFrame, folder: str | None = None, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id.

    component_id is the smallest doc_id that links of at most ``radius`` bits reach. A null or
    empty text has the fingerprint zero and is linked like any other. Repeated rows and ties
    are in the same component. A null doc_id takes no part in the minimum. An empty table
    gives no rows. Other columns are not read.
    """
    rows = grouped(docs, folder or new_folder(docs.sparkSession), radius)
    return rows.select("doc_id", hexadecimal("fp").alias("fingerprint"), "component_id")


def hexadecimal(column: str) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def drop_near_copies(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest doc_id.

    Of rows that repeat this doc_id one stays. All columns are as they were.
    """
    folder = folder or new_folder(docs.sparkSession)
    numbered = stored(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered", folder)
    groups = stored(grouped(numbered, folder), "groups", folder)
    best = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keep = best.groupBy("component").agg(F.min("row").alias("row"))
    keep = stored(keep.select(F.col("row").alias(ROW)), "keep", folder)
    return numbered.join(small(keep), ROW, "left_semi").select(*docs.columns)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(read_documents(spark, sf_dir))
