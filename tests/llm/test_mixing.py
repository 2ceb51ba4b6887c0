import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from feira.llm import mixing
from feira.llm.common import read_documents
from tests.conftest import executed_plan
from tests.llm.conftest import SF, same

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    """Shares by weight; those above their limit get it, the excess is shared again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {name: i % 3 + 1 for i, name in enumerate(names)}
    total, target = sum(sizes.values()), {}
    while True:
        open_ = [n for n in names if n not in target]
        rest = total - sum(target.values())
        unit = rest / sum(weight[n] for n in open_) if open_ else 0
        over = [n for n in open_ if unit * weight[n] > 3 * sizes[n]]
        if not over:
            return target | {n: unit * weight[n] for n in open_}
        target |= {n: 3 * sizes[n] for n in over}


def check(frame, rows):
    found = mixing.mixture(frame).collect()
    sizes = defaultdict(int)
    for row in rows:
        sizes[row[3]] += len(WORD.findall(row[1] or ""))
    targets = brute_targets(sizes)
    assert same([(r.doc_id, r.size) for r in found], [(r[0], len(WORD.findall(r[1] or ""))) for r in rows])
    assert all(r.taken <= 3 * r.size for r in found)
    expected = sorted((sizes[s], round(targets[s], 6)) for s in sizes)
    assert sorted({(r.source_size, round(r.target, 6)) for r in found}) == sorted(set(expected))
    return found


def test_rows_of_any_kind(documents, rows):
    check(documents, rows)


def test_sources_come_near_their_targets(spark):
    frame = read_documents(spark, SF)
    rows = [tuple(row) for row in frame.collect()]
    found = check(frame, rows)
    source = {row[0]: row[3] for row in rows}
    taken, target = defaultdict(int), {}
    for row in found:
        taken[source[row.doc_id]] += row.taken
        target[source[row.doc_id]] = row.target
    for name, words in taken.items():
        assert words == pytest.approx(target[name], rel=0.1, abs=2 * mixing.BLOCK_WORDS)


def test_layout_does_not_matter(documents):
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    first = mixing.mixture(documents).select(*columns).collect()
    again = mixing.mixture(documents.repartition(5, "text")).select(*columns).collect()
    assert same(map(tuple, first), map(tuple, again))


@pytest.mark.parametrize("count", [1, 2, 3, 5, 64, 100, 1000])
def test_permutations(spark, count):
    numbers = spark.range(count).select(
        mixing.permuted(F.col("id"), F.lit(count).cast("long"), F.lit(3)).alias("to")
    )
    assert sorted(row.to for row in numbers.collect()) == list(range(count))


def test_documents_are_repeated_whole(documents):
    left = mixing.repeat_by_mixture(documents)
    assert left.columns == documents.columns
    texts = {row.text for row in documents.collect()}
    assert all(row.text in texts for row in left.collect())


def test_no_python_on_the_way(documents):
    plan = executed_plan(mixing.mixture(documents))
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_drawn_blocks_are_not_broadcast(documents, conf):
    """They grow with the input, whatever size Spark expects of them."""
    conf(autoBroadcastJoinThreshold="1g")
    plan = executed_plan(mixing.mixture(documents))
    joins = re.findall(r"(\w+Join)\S* \[sid\S* block", plan)
    assert joins == ["SortMergeJoin"]


def test_rows_without_words_are_spread(spark, documents, tmp_path):
    """A shuffle by source and block must not bring them all to one task."""
    empties = spark.range(50).selectExpr("id AS doc_id", "' ' AS text", "'s0' AS source")
    mixed = empties.unionByName(documents.select("doc_id", "text", "source").where("source = 's0'"))
    folder = str(tmp_path)
    rows = mixing.stored(mixing.sized(mixed), "sizes", folder)
    sources = mixing.stored(mixing.targets(rows), "sources", folder)
    found = mixing.pieces(rows, sources, folder).where("size = 0").collect()
    assert len(found) == len({(r.sid, r.block) for r in found}) >= 50
    assert all(r.block < 0 and r.words == 0 for r in found)
    taken = mixing.mixture(mixed).where("size = 0").collect()
    assert len(taken) == len(found) and {r.taken for r in taken} == {0}


def test_empty(empty, spark, documents):
    assert mixing.mixture(empty).collect() == []
    assert mixing.repeat_by_mixture(empty).collect() == []
    nothing = documents.withColumn("text", F.lit(None).cast("string"))
    assert {(r.size, r.taken, r.target) for r in mixing.mixture(nothing).collect()} == {(0, 0, 0.0)}
