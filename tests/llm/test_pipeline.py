"""The pipeline and the registered queries, against SQL and brute force over whole tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as registered
import corpus_pipeline
from feira.llm import exact_dedup, mixing, quality_rules, registry, simhash
from feira.llm.common import read_documents
from tests.llm.conftest import SF, same
from tests.llm.test_bpe import library_ids
from tests.llm.test_simhash import brute_components, brute_fingerprint


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_same_rows_as_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "conversations", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    result = connection.execute(registry.ORACLE_SQL[name])
    columns = [column[0] for column in result.description]
    df = registry.QUERIES[name](spark, SF)
    assert set(df.columns) == set(columns)
    assert same(map(tuple, df.select(*columns).collect()), result.fetchall())


def test_one_query_for_each_operator():
    numbers = [int(name[2:].split("_")[0]) for name in registry.QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert set(registry.QUERIES) | {"pipeline"} <= set(registered.queries())


def test_stages(spark, tmp_path):
    """Every stage against a brute-force account of what it has to keep."""
    docs = read_documents(spark, SF)
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, before, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append((name, before.collect(), docs))
    (_, raw, quality), (_, good, exact), (_, single, near), (_, far, mixed), (_, chosen, coded) = kept
    assert all(frame.columns == read_documents(spark, SF).columns for frame in (quality, exact, near, mixed))

    verdicts = quality_rules.quality_verdicts(read_documents(spark, SF)).where("kept")
    assert same([r.doc_id for r in quality.collect()], [r.doc_id for r in verdicts.collect()])

    largest = {}
    for row in good:
        largest[row.text] = max(largest.get(row.text, -1), row.doc_id)
    assert same([(r.text, r.doc_id) for r in exact.collect()], largest.items())

    values, ids = [brute_fingerprint(row.text) for row in single], [row.doc_id for row in single]
    assert same([r.doc_id for r in near.collect()], set(brute_components(values, ids)))

    copies = Counter(row.doc_id for row in mixed.collect())
    taken = {r.doc_id: r.taken / r.size for r in mixing.mixture(spark.createDataFrame(far)).collect()}
    for doc_id, share in taken.items():
        assert int(share) <= copies[doc_id] <= int(share) + 1
        assert copies[doc_id] == share or share != int(share)

    expected = [(row.doc_id, tuple(library_ids(row.text))) for row in chosen]
    assert same([(r.doc_id, tuple(r.ids)) for r in coded.collect()], expected)


def test_run_is_the_stages_in_order(spark, tmp_path):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact", "near", "mix", "encode"]
    docs = read_documents(spark, SF)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    found = corpus_pipeline.run(spark, SF).select("doc_id", "ids_sha256").collect()
    assert same(map(tuple, found), map(tuple, docs.select("doc_id", "ids_sha256").collect()))


def test_stages_take_empty_tables(spark, empty):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == []


def test_stages_take_rows_of_any_kind(spark, documents):
    for module in (
        quality_rules.drop_rejected, exact_dedup.drop_exact_copies, simhash.drop_near_copies, mixing.repeat_by_mixture
    ):
        assert set(map(tuple, module(documents).collect())) <= set(map(tuple, documents.collect()))
