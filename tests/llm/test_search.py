import math
import random
import re
from collections import Counter

import duckdb
import pytest

from feira.llm import lexical_search as ls
from tests.llm.conftest import SF, same

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_terms(text):
    return TERM.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def brute_search(documents, items, top):
    """(item_id, rank, score) and all that may stand there, by adding up every term."""
    counts = [Counter(brute_terms(text)) for _, text in documents]
    lengths = [sum(c.values()) for c in counts]
    n_docs, length = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(term for c in counts for term in c)
    asked = {}
    for item_id, text in items:
        asked.setdefault(item_id, set()).update(brute_terms(text))
    out = []
    for item_id, wanted in asked.items():
        found = []
        for (doc_id, _), c, n in zip(documents, counts, lengths, strict=True):
            score = 0
            for term in wanted & c.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                m = 50 + (50 * n * n_docs) // length
                score += w * ((1_000_000_000 * c[term]) // (1000 * c[term] + 20 * m))
            if score > 0:
                found.append((-score, doc_id is not None, doc_id, score))
        found.sort(key=lambda f: (f[0], f[1], f[2] or 0))
        out += [(item_id, rank, f[2], f[3]) for rank, f in enumerate(found[:top], 1)]
    return out


def generated(rng, n):
    words = [f"w{i}" for i in range(300)] + ["Été", "字字", "the", "THE"]
    weights = [1 / (i + 1) for i in range(300)] + [1, 0.1, 2, 1]
    return [" ".join(rng.choices(words, weights, k=rng.randint(0, 60))) + rng.choice(["", ".", "-x_y"]) for _ in range(n)]


@pytest.fixture
def many(spark):
    rng = random.Random(8)
    documents = list(zip(rng.sample(range(5000), 1500), generated(rng, 1500), strict=True))
    items = list(enumerate(generated(rng, 30)))
    frames = [spark.createDataFrame(documents, "doc_id long, text string").repartition(5)]
    frames.append(spark.createDataFrame(items, "item_id long, text string"))
    return documents, items, *frames


@pytest.mark.parametrize(
    ("top", "owners", "shard", "block"), [(50, 4, 4096, 256), (5, 3, 100, 7), (1, 1, 64, 256), (2000, 5, 300, 10)]
)
def test_equals_brute_force(many, tmp_path, monkeypatch, top, owners, shard, block):
    """Whatever the number of owners, shards and blocks of items."""
    documents, items, docs, asked = many
    monkeypatch.setattr(ls, "SHARD_DOCUMENTS", shard)
    monkeypatch.setattr(ls, "BLOCK_ITEMS", block)
    found = ls.search(docs, asked, top, owners, str(tmp_path)).collect()
    assert same(map(tuple, found), brute_search(documents, items, top))


def test_a_vocabulary_that_is_not_sent(many, tmp_path, monkeypatch):
    documents, items, docs, asked = many
    monkeypatch.setattr(ls, "VOCABULARY_TERMS", 10)
    found = ls.search(docs, asked, 20, folder=str(tmp_path)).collect()
    assert same(map(tuple, found), brute_search(documents, items, 20))


def test_bundles_leave_behind_what_cannot_win(many, tmp_path):
    documents, _, docs, asked = many
    ls.search(docs, asked, 5, folder=str(tmp_path)).collect()
    spark = docs.sparkSession
    held = spark.read.parquet(f"{tmp_path}/stage_2").selectExpr("sum(length(scores)) / 8").first()[0]
    matching = sum(1 for _ in brute_search(documents, list(map(tuple, asked.collect())), 10**6))
    assert 0 < held < matching / 2


def test_query_and_its_sql(spark):
    found = [tuple(row) for row in ls.op11_lexical_search(spark, SF).collect()]
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    expected = connection.execute(ls.OP11_SQL).fetchall()
    assert expected
    assert same(found, expected)


def test_rows_of_any_kind(spark, documents, rows, tmp_path):
    items = [(row[0], row[1], 1) for row in rows]
    asked = spark.createDataFrame(items, "item_id long, text string, score int")
    found = ls.search(documents, asked, folder=str(tmp_path)).collect()
    expected = brute_search([row[:2] for row in rows], [item[:2] for item in items], 50)
    assert same(map(tuple, found), expected)


def test_empty(spark, documents, empty, tmp_path):
    asked = spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert ls.search(empty, asked, folder=f"{tmp_path}/a").collect() == []
    assert ls.search(documents, asked.limit(0), folder=f"{tmp_path}/b").collect() == []
    nothing = spark.createDataFrame([(1, None), (2, " .,")], "item_id long, text string")
    assert ls.search(documents, nothing, folder=f"{tmp_path}/c").collect() == []
