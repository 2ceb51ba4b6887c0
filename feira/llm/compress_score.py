"""Quality classifier by compression.

Two zstandard dictionaries are built, one from texts labelled good, one from texts labelled
bad. A text is compressed with each, in chunks, so that the dictionary counts for all of a
long text; the difference of the sizes over their sum says which dictionary knows the text
better. A logistic curve, fitted on labelled texts that the dictionaries have not seen, turns
it into a score from 0 to 1.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.llm.common import byte_texts, read_documents, ship, sliced

# The classifier is fitted on a sample: so many labelled rows of each class at most, and of
# each so many bytes, in chunks from all over a longer text. Half of the rows build the
# dictionaries, the others fit the curve.
TRAIN_ROWS = 2_000
TRAIN_BYTES = 1 << 15
DICTIONARY_BYTES = 1 << 15
CHUNK = 512
LEVEL = 3
GOOD_SCORE = 0.7
# Rows with this remainder are never learnt from.
HELD_OUT = 2

_SCORED = "doc_id long, held_out boolean, score double, predicted int"


def held_out(doc_id: str = "doc_id") -> Column:
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")
    return F.crc32(key) % 4 == HELD_OUT


@dataclass
class Model:
    """Dictionaries and the curve: score = 1 / (1 + exp(-(slope * difference + shift)))."""

    good: bytes
    bad: bytes
    slope: float
    shift: float

    def __post_init__(self):
        self._compressors = None

    def __getstate__(self):
        return self.__dict__ | {"_compressors": None}

    def difference(self, data: bytes) -> float:
        """Above zero if the dictionary of good texts makes the text smaller; 0 if it is empty."""
        if self._compressors is None:
            self._compressors = [_compressor(content) for content in (self.good, self.bad)]
        sizes = [0, 0]
        for begin in range(0, len(data), CHUNK):
            chunk = data[begin : begin + CHUNK]
            for i, compressor in enumerate(self._compressors):
                sizes[i] += len(compressor.compress(chunk))
        return (sizes[1] - sizes[0]) / max(1, sum(sizes))

    def score(self, data: bytes) -> float:
        exponent = self.slope * self.difference(data) + self.shift
        return float(1 / (1 + np.exp(-np.clip(exponent, -50, 50))))


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    dictionary = zstandard.ZstdCompressionDict(content)
    if len(content) >= 8:
        dictionary.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            level=LEVEL, dict_data=dictionary, write_content_size=False, write_dict_id=False
        )
    return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves where there are too few to train on."""
    pieces = [text[i : i + CHUNK] for text in samples for i in range(0, len(text), CHUNK)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICTIONARY_BYTES:]


def fit_curve(
    differences: np.ndarray, labels: np.ndarray, weights_of_rows: np.ndarray
) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton's steps with a little shrinkage."""
    if len(labels) == 0:
        return 0.0, 0.0
    scale = max(float(np.abs(differences).max()), 1e-9)
    x = np.column_stack([differences / scale, np.ones(len(labels))])
    weights, shrink = np.zeros(2), np.diag([1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -50, 50)))
        gradient = x.T @ (weights_of_rows * (labels - p)) - shrink @ weights
        curvature = (x * (weights_of_rows * p * (1 - p) + 1e-9)[:, None]).T @ x + shrink
        step = np.linalg.solve(curvature, gradient)
        weights += step
        if np.abs(step).max() < 1e-9:
            break
    return float(weights[0] / scale), float(weights[1])


def fit(rows: list[tuple[int, int, bytes]], counts: dict[int, int]) -> Model:
    """A model from (doc_id, label, text) rows; ``counts`` has all usable labels of each class.

    With no row of a class its dictionary is empty. The curve weighs the rows of a class so
    that the classes have their shares among all labels, whatever their shares in the sample.
    """
    build, curve = [], []
    for label in (0, 1):
        own = sorted((r for r in rows if r[1] == label), key=lambda r: (zlib.crc32(r[2]), r[0]))
        build += own[::2]
        curve += own[1::2]
    good = dictionary([text for _, label, text in build if label == 1])
    bad = dictionary([text for _, label, text in build if label == 0])
    model = Model(good, bad, 0.0, 0.0)
    differences = np.array([model.difference(text) for _, _, text in curve])
    labels = np.array([label for _, label, _ in curve], float)
    sampled = {label: max(1, int((labels == label).sum())) for label in (0, 1)}
    each = {label: counts.get(label, 0) / sampled[label] for label in (0, 1)}
    mean = max(1e-9, sum(each[int(label)] for label in labels) / max(1, len(labels)))
    weights = np.array([each[int(label)] / mean for label in labels])
    model.slope, model.shift = fit_curve(differences, labels, weights)
    return model


def _spread(text: Column) -> Column:
    """The bytes of a text; of one longer than ``TRAIN_BYTES`` chunks at even distances, the
    first at its beginning and the last at its end."""
    count = TRAIN_BYTES // CHUNK
    size = F.octet_length(text)
    begins = F.transform(
        F.sequence(F.lit(0), F.lit(count - 1)),
        lambda i: F.floor(i * (size - CHUNK).cast("double") / (count - 1)).cast("int") + 1,
    )
    chunks = F.transform(begins, lambda begin: F.substring(text, begin, F.lit(CHUNK)))
    joined = F.aggregate(chunks, F.lit(b""), lambda done, chunk: F.concat(done, chunk))
    return F.when(size <= TRAIN_BYTES, text).otherwise(joined)


def training_rows(
    docs: DataFrame, labels: DataFrame
) -> tuple[list[tuple[int, int, bytes]], dict[int, int]]:
    """The sample to learn from: per class the ``TRAIN_ROWS`` labelled rows with the lowest hash
    of their doc_id, none of them held out; and how many such labels there are."""
    usable = labels.where(~held_out() & F.col("quality").isin(0, 1)).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")
    )
    counts = {row[0]: row[1] for row in usable.groupBy("quality").count().collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    classes = [
        usable.where(F.col("quality") == label).distinct().orderBy(*order).limit(TRAIN_ROWS)
        for label in (0, 1)
    ]
    sample = classes[0].union(classes[1])
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    joined = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _spread(text).alias("data")
    ).join(F.broadcast(sample), "doc_id")
    # one text for each sampled label, so at most 2 * TRAIN_ROWS rows come here
    rows = joined.groupBy("doc_id", "quality").agg(F.min("data"))
    return [(row[0], row[1], bytes(row[2])) for row in rows.collect()], counts


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Only the text goes into a score; a null text is an empty one and gets the score of no
    difference. Rows without a quality label are not learnt from, without any label all scores
    are one half. Repeated rows get the same score, a null doc_id counts as the empty text in
    the split, an empty table gives no rows. Other columns are not read.
    """
    ship(docs.sparkSession)
    # dictionaries of DICTIONARY_BYTES each and two numbers go to the executors
    model = docs.sparkSession.sparkContext.broadcast(fit(*training_rows(docs, labels)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            scores = [model.value.score(data) for data in byte_texts(batch["text"])]
            columns = [
                batch["doc_id"],
                batch["held_out"],
                pa.array(scores, pa.float64()),
                pa.array([int(s >= GOOD_SCORE) for s in scores], pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    light = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text"
    )
    return light.mapInArrow(score, _SCORED)


def op9_compression_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
