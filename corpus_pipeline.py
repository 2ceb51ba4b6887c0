"""A corpus made ready for training: quality rules, exact and near dedup, mixing, token ids.

Each stage takes (spark, documents, folder of tables) and returns the documents that it
keeps, whole rows; the last one returns their token ids. Stages are written as Parquet and
read again, so each works on all that the one before it kept, and a lost executor costs no
more than the stage that runs.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from feira.llm import bpe, exact_dedup, mixing, quality_rules, simhash
from feira.llm.common import read_documents, stored
from feira.sources.working import new_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.drop_rejected(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    return exact_dedup.drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the one with the smallest doc_id stays."""
    return simhash.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix of sources takes them."""
    return mixing.repeat_by_mixture(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the text decoded from them."""
    return bpe.round_trip(docs, public_tokenizers.path(bpe.VOCABULARY), with_ids=True)


STAGES = [
    ("quality", quality),
    ("exact", exact),
    ("near", near),
    ("mix", mix),
    ("encode", encode),
]

# SimHash components, the draw of the mix and token ids are not SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark)
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name, folder)
    return docs
