"""Exact dedup by an exchange of compressed fingerprints.

Rows are dealt to senders. A sender cuts the range of fingerprints among the owners and
sends each its sorted, Golomb-coded share. An owner sees which fingerprints came from more
than one sender and answers each sender with a bitmap. Only rows whose fingerprint is marked
there, or met twice in one sender, are suspects; only suspects' texts are shuffled and
compared byte by byte. Everything else that moves is a digest or a few bits per row.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.llm import golomb
from feira.llm.common import read_documents, ship, small, stored
from feira.sources.working import new_folder

# Fingerprints have so many bits; equal ones of different texts only cost a comparison.
FINGERPRINT_BITS = 48
# A message from a sender to an owner holds this many fingerprints on average.
MESSAGE_SIZE = 64

ROW = "_feira_row"


def digests(docs: DataFrame) -> DataFrame:
    """One light row per document: row number, doc_id, digest and fingerprint of the text."""
    row = F.col(ROW) if ROW in docs.columns else F.monotonically_increasing_id()
    sha = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    bits = F.conv(F.substring("text_sha256", 1, FINGERPRINT_BITS // 4), 16, 10).cast("long")
    return docs.select(
        row.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), sha.alias("text_sha256")
    ).withColumn("fingerprint", bits)


def _shares(fingerprints: np.ndarray, owners: int) -> list[np.ndarray]:
    """Sorted different fingerprints, cut by owner into numbers from the owner's start."""
    width = -(-(1 << FINGERPRINT_BITS) // owners)
    values = np.unique(fingerprints.astype(np.uint64))
    cuts = np.searchsorted(values, np.arange(1, owners, dtype=np.uint64) * np.uint64(width))
    return [
        part - np.uint64(owner * width) for owner, part in enumerate(np.split(values, cuts))
    ]


def _send(owners: int):
    def send(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        shares = _shares(rows["fingerprint"].to_numpy(), owners)
        return pd.DataFrame(
            [(i, key[0], golomb.encode(part)) for i, part in enumerate(shares) if len(part)],
            columns=["owner", "sender", "code"],
        )

    return send


def _answer(key: tuple, messages: pd.DataFrame) -> pd.DataFrame:
    """A bitmap for each sender: which of its fingerprints came from another one as well."""
    lists = [golomb.decode(code) for code in messages["code"]]
    values, counts = np.unique(np.concatenate(lists), return_counts=True)
    shared = values[counts > 1]
    bitmaps = [np.packbits(np.isin(values, shared)).tobytes() for values in lists]
    return pd.DataFrame({"owner": key[0], "sender": messages["sender"], "bitmap": bitmaps})


def _suspects(owners: int):
    def suspects(
        key: tuple, rows: pd.DataFrame, answers: pd.DataFrame
    ) -> pd.DataFrame:
        fingerprints = rows["fingerprint"].to_numpy().astype(np.uint64)
        width = np.uint64(-(-(1 << FINGERPRINT_BITS) // owners))
        values, counts = np.unique(fingerprints, return_counts=True)
        marked = [values[counts > 1]]
        shares = _shares(fingerprints, owners)
        for owner, bitmap in zip(answers["owner"], answers["bitmap"], strict=True):
            part = shares[owner]
            bits = np.unpackbits(np.frombuffer(bitmap, np.uint8), count=len(part))
            marked.append(part[bits == 1] + np.uint64(owner) * width)
        found = np.isin(fingerprints, np.concatenate(marked))
        return rows.loc[found, ["row", "doc_id", "text_sha256"]]

    return suspects


def suspects(light: DataFrame, owners: int) -> DataFrame:
    """The rows of ``light`` (as from ``digests``, stored) whose fingerprint another row has too."""
    dealt = light.withColumn("sender", F.pmod(F.xxhash64("row"), F.lit(owners)).cast("int"))
    own = dealt.select("sender", "row", "doc_id", "text_sha256", "fingerprint")
    messages = own.groupBy("sender").applyInPandas(
        _send(owners), "owner int, sender int, code binary"
    )
    answers = messages.groupBy("owner").applyInPandas(
        _answer, "owner int, sender int, bitmap binary"
    )
    return (
        own.groupBy("sender")
        .cogroup(answers.groupBy("sender"))
        .applyInPandas(_suspects(owners), "row long, doc_id long, text_sha256 string")
    )


def copies(docs: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Light rows of all documents, and of each group of equal texts the row that stays.

    The second table has text_sha256, keep_id, keep_row and group_size, for texts that occur
    more than once. Of equal texts the largest doc_id stays, null being the smallest; of rows
    that repeat the doc_id too, the last row number.
    """
    ship(docs.sparkSession)
    light = stored(digests(docs), "digests", folder)
    owners = max(1, math.ceil(math.sqrt(light.count() / MESSAGE_SIZE)))
    found = stored(suspects(light, owners), "suspects", folder)
    winner = F.max(F.struct("doc_id", "row"))
    groups = found.groupBy("text_sha256").agg(F.count("*").alias("group_size"), winner.alias("w"))
    groups = stored(
        groups.where("group_size > 1").select(
            "text_sha256",
            F.col("w.doc_id").alias("keep_id"),
            F.col("w.row").alias("keep_row"),
            "group_size",
        ),
        "groups",
        folder,
    )
    return light, stored(verified(docs, groups), "verified", folder)


def verified(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """``groups`` after their texts were compared; fails if two texts share a digest.

    Equal texts are merged in each task before they are shuffled, so a text that fills a
    third of all rows moves once per task.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    hashed = docs.select(text.alias("text")).withColumn("text_sha256", F.sha2("text", 256))
    suspect_texts = hashed.join(small(groups.select("text_sha256")), "text_sha256", "left_semi")
    compared = (
        suspect_texts.groupBy("text_sha256", "text")
        .agg(F.count("*").alias("n"))
        .groupBy("text_sha256")
        .agg(F.count("*").alias("texts"), F.sum("n").alias("n"))
    )
    same = (F.col("texts") == 1) & (F.col("n") == F.col("group_size"))
    checked = F.when(same, F.col("group_size")).otherwise(
        F.raise_error(F.concat(F.lit("texts differ for digest "), F.col("text_sha256"))).cast("long")
    )
    return groups.join(compared, "text_sha256").select(
        "text_sha256", "keep_id", "keep_row", checked.alias("group_size")
    )


def exact_groups(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    A null text counts as empty. Rows that repeat a doc_id with the same text count in
    group_size, and one of them is kept. A null doc_id is the smallest. An empty table gives
    no rows. Other columns are not read.
    """
    light, groups = copies(docs, folder or new_folder(docs.sparkSession))
    keep = F.col("keep_row").isNull() | (F.col("keep_row") == F.col("row"))
    keep_id = F.when(F.col("keep_row").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return light.join(small(groups), "text_sha256", "left").select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        keep.alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were."""
    folder = folder or new_folder(docs.sparkSession)
    numbered = stored(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered", folder)
    light, groups = copies(numbered, folder)
    dropped = (
        light.join(small(groups), "text_sha256")
        .where(F.col("row") != F.col("keep_row"))
        .select(F.col("row").alias(ROW))
    )
    dropped = stored(dropped, "dropped", folder)
    return numbered.join(small(dropped), ROW, "left_anti").select(*docs.columns)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read_documents(spark, sf_dir))


OP6_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY body)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept,
       sha256(d.body) AS text_sha256
FROM d JOIN g ON d.body = g.body
"""
