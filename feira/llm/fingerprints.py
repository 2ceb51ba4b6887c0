"""Document fingerprints: SimHash of weighted terms, searched through permuted block tables.

Every term of a text votes on each of 128 bits, for or against as the bit of its hash says, with
its weight: the times it occurs, times how rare it is among all documents. Documents per term
are counted by hash in a fixed number of slots, so the counts have a bound, whatever the number
of different terms. Weights and votes are whole numbers, so equal texts have equal fingerprints
in whatever order they are added.

Fingerprints within the radius r: the bits are cut into B blocks. If two fingerprints differ in at
most r bits, B - r blocks at least are equal in both. For each choice of B - r blocks there is a
table of all different fingerprints, permuted so that the chosen blocks stand first; those with
equal first blocks are compared. Of each group only the links of a spanning forest leave the task.
"""

from collections.abc import Iterator
from hashlib import sha256
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feira.llm.common import read_documents, ship, sliced, small, stored, texts
from feira.llm.components import components
from feira.sources.working import new_folder

BITS = 128
RADIUS = 6
BLOCKS = 8
# Documents per term are counted in so many slots; two terms in one slot share their weight.
SLOTS = 1 << 16
# Weights are whole numbers of this part of a unit of the logarithm, from 1.
WEIGHT_UNITS = 8
# Texts are handled together up to so many bytes.
BATCH_BYTES = 1 << 22
# A group with more fingerprints is cut into parts, and all pairs of parts are compared as
# separate groups, so that no task holds more than two parts.
PART = 4096
# Words whose votes are added at a time.
VOTES_AT_ONCE = 1 << 14

ROW = "_feira_row"
EDITS = (
    "row long, doc_id long, n_chars long, edited_sha256 binary, hi long, lo long, "
    "edited_hi long, edited_lo long, next_hi long, next_lo long, "
    "is_first boolean, is_last boolean, text string"
)


def terms(text: str) -> list[bytes]:
    """Words in lower case (A-Z only), split at the six ASCII white-space characters."""
    return text.encode().lower().split()


def _numbered(documents: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of all terms in a row, where each document ends, and the digests of the terms."""
    flat = [term for found in documents for term in found]
    ends = np.cumsum([len(found) for found in documents]).astype(np.int64)
    if not flat:
        return np.zeros(0, np.int64), ends, np.zeros((0, BITS // 8), np.uint8)
    numbers, different = pd.factorize(np.array(flat, dtype=object))
    digests = b"".join(map(xxhash.xxh3_128_digest, different))
    return numbers, ends, np.frombuffer(digests, np.uint8).reshape(-1, BITS // 8)


def _slots(digests: np.ndarray) -> np.ndarray:
    """The slot of each digest, from its last four bytes."""
    return np.ascontiguousarray(digests[:, -4:]).view("<u4")[:, 0] % SLOTS


def _count_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(SLOTS, np.int64)
    documents = 0
    for batch in sliced(batches, BATCH_BYTES):
        numbers, ends, digests = _numbered([terms(text) for text in texts(batch["text"])])
        documents += batch.num_rows
        owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        pairs = pd.unique(owner * np.int64(len(digests) + 1) + numbers)
        per_term = np.bincount(pairs % (len(digests) + 1), minlength=len(digests))
        counts += np.bincount(_slots(digests), per_term[: len(digests)], SLOTS).astype(np.int64)
    used = np.flatnonzero(counts)
    slots = np.concatenate([[-1], used]).astype(np.int32)
    yield pa.RecordBatch.from_arrays(
        [pa.array(slots), pa.array(np.concatenate([[documents], counts[used]]))], ["slot", "n"]
    )


def slot_weights(docs: DataFrame) -> np.ndarray:
    """The weight of each slot from the counts over all documents: a table of fixed size."""
    ship(docs.sparkSession)
    partial = docs.select("text").mapInArrow(_count_slots, "slot int, n long")
    counted = partial.groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SLOTS + 1)
    counts[counted["slot"]] = counted["n"]
    total = counts[-1]
    rarity = np.log((total + 1) / (counts[:-1] + 1))
    return (1 + np.rint(WEIGHT_UNITS * np.maximum(rarity, 0))).astype(np.int16)


def fingerprints_of(documents: list[list[bytes]], weights: np.ndarray) -> np.ndarray:
    """The bits of each document as a row of two signed numbers; no terms give zero."""
    numbers, ends, digests = _numbered(documents)
    signs = 2 * np.unpackbits(digests, axis=1).astype(np.int16) - 1
    signs *= weights[_slots(digests)][:, None]
    bits = np.zeros((len(documents), BITS), bool)
    begin = 0
    for i, end in enumerate(ends.tolist()):
        votes = np.zeros(BITS, np.int64)
        for j in range(begin, end, VOTES_AT_ONCE):
            # a vote is below 2^9, so the sum of one step stays in 32 bits
            votes += signs[numbers[j : min(end, j + VOTES_AT_ONCE)]].sum(axis=0, dtype=np.int32)
        bits[i] = votes > 0
        begin = end
    return np.packbits(bits, axis=1).view(">i8").astype(np.int64).reshape(-1, 2)


def edit(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _edited(weights: np.ndarray):
    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in order. The last row of a task waits for another task's first one."""
        held, is_first = None, True

        def out(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _EDIT_TYPES, strict=True)],
                [field.split()[0] for field in EDITS.split(", ")],
            )

        for batch in sliced(batches, BATCH_BYTES):
            new = list(texts(batch["text"]))
            pairs = zip([held[2], *new] if held else new, new if held else new[1:], strict=False)
            changed = [edit(a, b) for a, b in pairs]
            prints = fingerprints_of([terms(t) for t in new + changed], weights).tolist()
            own, theirs = prints[: len(new)], prints[len(new) :]
            rows = list(zip(batch["row"].to_pylist(), batch["doc_id"].to_pylist(), new, own, strict=True))
            rows = [held, *rows] if held else rows
            done = []
            for k, text in enumerate(changed):
                row, doc_id, before, print_ = rows[k]
                digest = sha256(text.encode()).digest()
                edge = before if is_first else None
                done.append(
                    (row, doc_id, len(before), digest, *print_, *theirs[k], *rows[k + 1][3], is_first, False, edge)
                )
                is_first = False
            held = rows[-1]
            if done:
                yield out(done)
        if held:
            row, doc_id, before, print_ = held
            yield out(
                [(row, doc_id, len(before), None, *print_, None, None, None, None, is_first, True, before)]
            )

    return edited


_EDIT_TYPES = [
    pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(),
    pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string(),
]


def _finished(weights: np.ndarray):
    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, BATCH_BYTES):
            pairs = zip(texts(batch["text"]), texts(batch["next_text"]), strict=True)
            changed = [edit(a, b) for a, b in pairs]
            prints = fingerprints_of([terms(t) for t in changed], weights)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["row"],
                    pa.array([sha256(t.encode()).digest() for t in changed], pa.binary()),
                    pa.array(np.ascontiguousarray(prints[:, 0])),
                    pa.array(np.ascontiguousarray(prints[:, 1])),
                ],
                ["row", "edited_sha256", "edited_hi", "edited_lo"],
            )

    return finished


def _fingerprint_batches(weights: np.ndarray):
    def fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, BATCH_BYTES):
            prints = fingerprints_of([terms(t) for t in texts(batch["text"])], weights)
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["doc_id"], *(pa.array(np.ascontiguousarray(prints[:, i])) for i in (0, 1))],
                ["row", "doc_id", "hi", "lo"],
            )

    return fingerprint_batches


def _numbered_rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )


def fingerprints(docs: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """row, doc_id, hi and lo (the bits as two signed numbers) of every document.

    A null or empty text has the fingerprint zero. Rows are handled one by one, also repeated
    ones and null doc_ids. An empty table gives no rows. Other columns are not read.
    """
    weights = slot_weights(docs) if weights is None else weights
    return _numbered_rows(docs).mapInArrow(
        _fingerprint_batches(weights), "row long, doc_id long, hi long, lo long"
    )


def with_edits(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Fingerprints of every text, of its edited text and of the next document, see ``EDITS``.

    The next document is the one that follows by doc_id, nulls first, repeated ones in the order of
    the table; after the last comes the first. Texts are sorted once, by a shuffle; what crosses
    the border of two tasks is one text for each task, which a join brings over afterwards.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark)
    weights = slot_weights(docs)
    order = ["doc_id", "row"]
    laid = _numbered_rows(docs).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stored(laid.mapInArrow(_edited(weights), EDITS), "edited", folder)
    edges = rows.where("is_first or is_last")
    # two narrow rows for each task of the sort
    by_id = W.orderBy(F.col("doc_id").asc_nulls_first(), "row")
    ends = W.orderBy(F.col("doc_id").asc_nulls_first(), "row").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    follows = edges.select("row", "is_last", F.coalesce(F.lead("row").over(by_id), F.first("row").over(ends)).alias("next_row"))
    follows = stored(follows.where("is_last").select("row", "next_row"), "follows", folder)
    theirs = edges.select(
        F.col("row").alias("next_row"), F.col("text").alias("next_text"),
        F.col("hi").alias("next_hi"), F.col("lo").alias("next_lo"),
    )
    met = edges.where("is_last").drop("next_hi", "next_lo", "edited_hi", "edited_lo", "edited_sha256")
    met = stored(met.join(follows, "row").join(theirs, "next_row"), "met", folder)
    changed = met.select("row", "text", "next_text").mapInArrow(
        _finished(weights), "row long, edited_sha256 binary, edited_hi long, edited_lo long"
    )
    completed = stored(met.drop("next_text", "next_row").join(changed, "row"), "completed", folder)
    whole = rows.where("not is_last").unionByName(completed)
    return whole.withColumn("edited_sha256", F.lower(F.hex("edited_sha256")))


def tables(radius: int = RADIUS, blocks: int = BLOCKS) -> list[tuple[int, ...]]:
    """Which blocks stand first in each table."""
    if not 0 <= radius < blocks or BITS % blocks:
        raise ValueError("more blocks than differing bits are needed, all of one size")
    return list(combinations(range(blocks), blocks - radius))


def _first_blocks(chosen: tuple[int, ...], blocks: int) -> Column:
    """The chosen blocks of hi and lo, one after the other, as text of 16-bit and other pieces."""
    width = BITS // blocks
    whole = F.concat(F.lpad(F.hex("hi"), 16, "0"), F.lpad(F.hex("lo"), 16, "0"))
    return F.concat(*[F.substring(whole, b * width // 4 + 1, width // 4) for b in chosen])


def forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links between rows of two numbers that connect what pairs within the radius connect.

    Rows that are reached are compared with those not reached yet, so every row is linked once
    at most, and in a dense group there is little left to compare after a few steps.
    """
    links, rest = [], np.arange(len(values))
    while len(rest):
        waiting, rest = [int(rest[0])], rest[1:]
        while waiting and len(rest):
            current = waiting.pop()
            differing = np.bitwise_count(values[rest] ^ values[current]).sum(axis=1)
            near = rest[differing <= radius]
            links += [(current, other) for other in near.tolist()]
            waiting += near.tolist()
            rest = rest[differing > radius]
    return links


def _group_links(radius: int):
    def group_links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by group; a group may go on in the next batch."""
        carried = None
        for frame in batches:
            frame = frame if carried is None else pd.concat([carried, frame], ignore_index=True)
            keys = frame[["place", "key", "part", "other"]]
            changes = np.flatnonzero((keys != keys.shift()).any(axis=1).to_numpy())
            carried = frame.iloc[changes[-1] :] if len(changes) else frame
            yield _links_of(frame, changes, radius)
        if carried is not None:
            yield _links_of(carried, np.array([0, len(carried)]), radius)

    return group_links


def _links_of(frame: pd.DataFrame, cuts: np.ndarray, radius: int) -> pd.DataFrame:
    """The links of the groups between the cuts."""
    values = frame[["hi", "lo"]].to_numpy(np.int64).view(np.uint64)
    nodes, found = frame["node"].to_numpy(), []
    for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if end - begin > 1:
            own = nodes[begin:end]
            found += [(own[a], own[b]) for a, b in forest(values[begin:end], radius)]
    return pd.DataFrame(np.array(found, np.int64).reshape(-1, 2), columns=["a", "b"])


def near_links(
    distinct: DataFrame, folder: str, radius: int = RADIUS, blocks: int = BLOCKS
) -> DataFrame:
    """Links (a, b) between the nodes of different fingerprints (node, hi, lo; stored).

    Whatever pairs within the radius connect is connected by links, and every link is such a
    pair. More blocks make longer first blocks, for more fingerprints, and more tables.
    """
    ship(distinct.sparkSession)
    firsts = F.array(
        *[F.struct(F.lit(i).alias("place"), _first_blocks(c, blocks).alias("key")) for i, c in enumerate(tables(radius, blocks))]
    )
    keyed = distinct.select("node", "hi", "lo", F.explode(firsts).alias("t")).select(
        "node", "hi", "lo", "t.place", F.xxhash64("t.key").alias("key")
    )
    sizes = keyed.groupBy("place", "key").agg(F.count("*").alias("n")).where("n > 1")
    sizes = stored(sizes, "groups", folder)
    parts = F.ceil(F.col("n") / F.lit(PART)).cast("int")
    part = F.pmod(F.xxhash64("node", "place"), parts).cast("int")
    # a member of part p goes to the groups (p, q) and (q, p) with the smaller number first
    pairs = F.transform(
        F.sequence(F.lit(0), parts - 1),
        lambda q: F.struct(F.least(q, part).alias("part"), F.greatest(q, part).alias("other")),
    )
    members = keyed.join(small(sizes), ["place", "key"]).select("*", F.explode(pairs).alias("p"))
    group = ["place", "key", "part", "other"]
    dealt = members.select("node", "hi", "lo", "place", "key", "p.part", "p.other")
    dealt = dealt.repartition(*group).sortWithinPartitions(*group)
    return dealt.mapInPandas(_group_links(radius), "a long, b long").distinct()


def near_classes(
    rows: DataFrame, folder: str, radius: int = RADIUS, blocks: int = BLOCKS
) -> DataFrame:
    """hi, lo and class_id for every different fingerprint of ``rows`` (doc_id, hi, lo).

    class_id is the smallest doc_id that links within the radius reach; null doc_ids take no part.
    """
    firsts = rows.groupBy("hi", "lo").agg(F.min("doc_id").alias("first"))
    distinct = stored(firsts.withColumn("node", F.monotonically_increasing_id()), "distinct", folder)
    nodes = components(near_links(distinct, folder, radius, blocks), folder)
    nodes = stored(nodes, "components", folder)
    members = distinct.join(small(nodes), "node", "left").select(
        "hi", "lo", "first", F.coalesce("component", "node").alias("component")
    )
    members = stored(members, "members", folder)
    lowest = stored(members.groupBy("component").agg(F.min("first").alias("class_id")), "lowest", folder)
    return members.join(small(lowest), "component").select("hi", "lo", "class_id")


def hexadecimal(hi: str, lo: str) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))


def likeness(a: tuple[str, str], b: tuple[str, str]) -> Column:
    """The share of bits that two fingerprints have in common."""
    differing = sum((F.bit_count(F.col(x).bitwiseXOR(F.col(y))) for x, y in zip(a, b, strict=True)), F.lit(0))
    return 1 - differing / F.lit(float(BITS))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark)
    rows = with_edits(read_documents(spark, sf_dir), folder)
    classes = stored(near_classes(rows, folder), "classes", folder)
    return rows.join(small(classes), ["hi", "lo"]).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hexadecimal("hi", "lo").alias("fingerprint"),
        hexadecimal("edited_hi", "edited_lo").alias("edited_fingerprint"),
        likeness(("hi", "lo"), ("edited_hi", "edited_lo")).alias("near_edited"),
        likeness(("hi", "lo"), ("next_hi", "next_lo")).alias("near_next"),
        "class_id",
    )
