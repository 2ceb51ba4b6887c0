import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from feira.llm import compress_score
from feira.llm.common import read_documents
from tests.llm.conftest import same

FOLDER = "/root/testdata/sf0.01"


def labels_of(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet")


def test_held_out_labels_are_told_apart(spark):
    scored = compress_score.op9_compression_score(spark, FOLDER)
    rows = scored.join(labels_of(spark), "doc_id").where("held_out").collect()
    assert np.mean([row.predicted == row.quality for row in rows]) > 0.95
    good = np.array([row.score for row in rows if row.quality == 1])
    bad = np.array([row.score for row in rows if row.quality == 0])
    assert (good[:, None] > bad).mean() > 0.97


def test_held_out_labels_teach_nothing(spark):
    docs, labels = read_documents(spark, FOLDER), labels_of(spark)
    turned = labels.withColumn(
        "quality", F.when(compress_score.held_out(), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    first = compress_score.scored(docs, labels).collect()
    assert same(map(tuple, first), map(tuple, compress_score.scored(docs, turned).collect()))
    for row in first:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
        assert row.predicted == (row.score >= 0.7)


def test_rows_of_any_kind(spark, documents, rows):
    labels = spark.createDataFrame(
        [(0, 1), (1, 0), (3, 1), (4, None), (5, 1), (7, 0), (None, 1), (8, 1), (8, 1), (9, 0)],
        "doc_id long, quality int",
    )
    found = compress_score.scored(documents, labels).collect()
    assert same([row.doc_id for row in found], [row[0] for row in rows])
    assert all(0 <= row.score <= 1 for row in found)


def test_without_labels_all_scores_are_one_half(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {row.score for row in compress_score.scored(documents, none).collect()} == {0.5}


def test_all_parts_of_long_texts_are_learnt_from(spark):
    """What tells the classes apart begins after twice the bytes that are kept of a text."""
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(600)]
    good, bad, other = words[:200], words[200:400], words[400:]

    def prose(own, size):
        return " ".join(rng.choices(own, k=size // 7))

    long = [(i, prose(other, 70_000) + " " + prose(good if i % 2 else bad, 30_000)) for i in range(80)]
    short = [(100 + i, prose(good if i % 2 else bad, 700)) for i in range(40)]
    docs = spark.createDataFrame(long + short, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    scores = {row.doc_id: row.score for row in compress_score.scored(docs, labels).collect()}
    assert all(scores[100 + i] > 0.5 if i % 2 else scores[100 + i] < 0.5 for i in range(40))
    sampled = compress_score.training_rows(docs, labels)[0]
    assert {len(text) for _, _, text in sampled} == {compress_score.TRAIN_BYTES}
    texts = dict(long)
    for doc_id, _, text in sampled:
        whole = texts[doc_id].encode()
        assert text[: compress_score.CHUNK] == whole[: compress_score.CHUNK]
        assert text[-compress_score.CHUNK :] == whole[-compress_score.CHUNK :]


def test_curve_gives_shares():
    x = np.array([-1.0, -1, 1, 1] * 50)
    labels = np.array([0.0, 1, 1, 1] * 50)
    slope, shift = compress_score.fit_curve(x, labels, np.ones(200))
    assert 1 / (1 + np.exp(slope - shift)) == pytest.approx(0.5, abs=0.02)
    assert 1 / (1 + np.exp(-slope - shift)) > 0.95


def test_empty(spark, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert compress_score.scored(empty, none).collect() == []
