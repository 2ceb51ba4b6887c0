"""Ranked lexical search over pipelined term owners.

The terms of all items are dealt to a few owners by falling weight, so that each owner answers for
about as many postings as another; documents are dealt to shards by hash, so that a term that
stands in a third of them is spread over all shards. A bundle is an item in a shard: its terms
with their weights, and a sparse accumulator of document places and whole-number scores. All
bundles visit the owners one after the other. At each stage bundles and the owner's postings
of the shard are brought together by a cogroup, contributions are added, and the bundle
goes on to the next owner. After the last one the best of each bundle are ranked by item.

Before a bundle goes on it leaves behind the documents that can no longer win: those whose score
plus all that later owners could still add is below the k-th best score in the bundle so far.
That is exact: the k-th best can only rise. As heavy terms come first, most documents that only
share frequent words with an item are left behind, or outweighed, early.
"""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feira.llm.common import byte_texts, read_documents, ship, sliced, small, stored
from feira.sources.working import new_folder

TOP = 50
# Stages: owners that the terms are dealt to.
OWNERS = 4
# A shard has about so many documents, and so many postings, or less.
SHARD_DOCUMENTS = 4096
SHARD_POSTINGS = 1 << 20
# Items are handled together in blocks of about so many.
BLOCK_ITEMS = 256
# Terms of all items are sent to every task up to this number and so many bytes; beyond, all
# terms of the documents are counted and joined with the items' by a shuffle.
VOCABULARY_TERMS = 200_000
VOCABULARY_BYTES = 8 << 20
BATCH_BYTES = 1 << 22
# Weights are counted in steps of this width to find the owners' borders.
WEIGHT_STEP = 100

BUNDLE = (
    "item long, block int, shard int, owners array<int>, ids array<long>, "
    "weights array<long>, tops array<long>, places binary, scores binary"
)

# Letters and digits stay, A-Z in lower case, and so do all bytes of other characters.
_LOWERED = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms(data: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of characters beyond ASCII; A-Z in lower case."""
    return data.translate(_LOWERED).split()


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, BATCH_BYTES):
        found = [sorted(set(terms(data))) for data in byte_texts(batch["text"])]
        lists = pa.array(found, pa.list_(pa.binary())).cast(pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([batch["item_id"], lists], ["item_id", "terms"])


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term), each once. Rows that repeat an item_id are one item; null is one too."""
    ship(items.sparkSession)
    light = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    lists = light.mapInArrow(_item_terms, "item_id long, terms array<string>")
    return lists.select("item_id", F.explode("terms").alias("term")).distinct()


def _count_terms(vocabulary: dict[bytes, int] | None):
    kind = pa.string() if vocabulary is None else pa.int64()

    def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, BATCH_BYTES):
            documents = [terms(data) for data in byte_texts(batch["text"])]
            sizes = np.array([len(found) for found in documents], np.int64)
            flat = [term for found in documents for term in found]
            numbers, different = pd.factorize(np.array(flat, dtype=object)) if flat else (np.zeros(0, np.int64), [])
            owner = np.repeat(np.arange(len(sizes)), sizes)
            if vocabulary is None:
                wanted = np.ones(len(different), bool)
                names = pa.array(list(different), pa.binary()).cast(pa.string())
            else:
                ids = np.array([vocabulary.get(term, -1) for term in different], np.int64)
                wanted, names = ids >= 0, pa.array(ids)
            kept = wanted[numbers]
            width = np.int64(max(1, len(different)))
            pairs, counts = np.unique(owner[kept] * width + numbers[kept], return_counts=True)
            ends = np.searchsorted(pairs, np.arange(len(sizes) + 1) * width).astype(np.int32)
            found = names.take(pa.array(pairs % width)) if len(pairs) else pa.array([], kind)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["row"],
                    batch["doc_id"],
                    pa.array(sizes),
                    pa.ListArray.from_arrays(pa.array(ends), found),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(counts.astype(np.int64))),
                ],
                ["row", "doc_id", "n", "terms", "tfs"],
            )

    return count_terms


def term_counts(docs: DataFrame, vocabulary: DataFrame) -> tuple[DataFrame, bool]:
    """row, doc_id, n (terms with repeats), terms and tfs of every document.

    Terms are the ids of the vocabulary's terms, if it is small enough to be sent to all tasks;
    if not, which the second value says, they are all the document's terms themselves.
    """
    ship(docs.sparkSession)
    light = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    size = vocabulary.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()
    wide = size[0] > VOCABULARY_TERMS or size[1] > VOCABULARY_BYTES
    sent = None if wide else {r.term.encode(): r.id for r in vocabulary.select("term", "id").collect()}
    kind = "string" if wide else "long"
    schema = f"row long, doc_id long, n long, terms array<{kind}>, tfs array<long>"
    return light.mapInArrow(_count_terms(sent), schema), wide


def _postings(placed: DataFrame, vocabulary: DataFrame, wide: bool, documents: int, length: int) -> DataFrame:
    """shard, local, id and factor: what a term of weight one adds to the document's score."""
    pairs = placed.select("shard", "local", "n", F.explode(F.arrays_zip("terms", "tfs")).alias("p")).select(
        "shard", "local", "n", F.col("p.terms").alias("id"), F.col("p.tfs").alias("tf")
    )
    if wide:
        pairs = pairs.withColumnRenamed("id", "term").join(vocabulary, "term").drop("term")
    measure = f"(50 + (50 * n * {documents}L) div {length}L)"
    return pairs.select("shard", "local", "id", F.expr(f"(1000000000L * tf) div (1000L * tf + 20L * {measure})").alias("factor"))


def _borders(weighted: DataFrame, owners: int) -> list[int]:
    """Weights below which the next owner begins, so that owners have about equal postings."""
    step = F.floor(F.col("weight") / WEIGHT_STEP).alias("step")
    # weights are below 1000 * ln(2 N + 2), so there are a few hundred steps at most
    steps = weighted.groupBy(step).agg(F.sum("df").alias("df")).orderBy(F.desc("step")).collect()
    total, passed, borders = sum(s["df"] for s in steps), 0, []
    for s in steps:
        passed += s["df"]
        while len(borders) < owners - 1 and passed * owners >= total * (len(borders) + 1):
            borders.append(s["step"] * WEIGHT_STEP)
    return borders


def _add(bundle, starts: dict[int, tuple[int, int]], places, factors, stage: int, last: bool, top: int):
    """One bundle after one owner: its accumulator with the owner's contributions."""
    owners, weights = np.asarray(bundle.owners), np.asarray(bundle.weights)
    ids = np.asarray(bundle.ids)
    rest = int((weights * np.asarray(bundle.tops))[owners > stage].sum())
    before = np.frombuffer(bundle.places, "<u4")
    found = [(before, np.frombuffer(bundle.scores, "<i8"))]
    for k in np.flatnonzero(owners == stage).tolist():
        begin, end = starts.get(int(ids[k]), (0, 0))
        if begin < end:
            found.append((places[begin:end], factors[begin:end] * weights[k]))
    at = np.concatenate([f[0] for f in found]).astype(np.int64)
    if not len(at):
        return b"", b""
    sums = np.zeros(int(at.max()) + 1, np.int64)
    for where, value in found:  # a document comes once in each
        sums[where] += value
    held = np.flatnonzero(sums)
    scores = sums[held]
    if len(held) > top:
        least = np.partition(scores, len(scores) - top)[len(scores) - top]
        can_win = scores + rest >= least
        held, scores = held[can_win], scores[can_win]
        if last:  # equal scores by place, which follows doc_id
            best = np.lexsort((held, -scores))[:top]
            held, scores = held[best], scores[best]
    return held.astype("<u4").tobytes(), scores.astype("<i8").tobytes()


def _stage(stage: int, last: bool, top: int):
    def visit(bundles: pd.DataFrame, postings: pd.DataFrame) -> pd.DataFrame:
        postings = postings.sort_values("id", kind="stable")
        ids = postings["id"].to_numpy()
        different, begins = np.unique(ids, return_index=True)
        ends = np.append(begins, len(ids))[1:]
        starts = dict(zip(different.tolist(), zip(begins.tolist(), ends.tolist(), strict=True), strict=True))
        places, factors = postings["local"].to_numpy(), postings["factor"].to_numpy()
        added = [_add(b, starts, places, factors, stage, last, top) for b in bundles.itertuples(index=False)]
        return bundles.assign(places=[a[0] for a in added], scores=[a[1] for a in added])

    return visit


def _unpacked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        places = [np.frombuffer(p, "<u4").astype(np.int64) for p in frame["places"]]
        scores = [np.frombuffer(s, "<i8") for s in frame["scores"]]
        sizes = [len(p) for p in places]
        yield pd.DataFrame(
            {
                "item": frame["item"].repeat(sizes).to_numpy(),
                "shard": frame["shard"].repeat(sizes).to_numpy(),
                "local": np.concatenate([np.zeros(0, np.int64), *places]),
                "score": np.concatenate([np.zeros(0, np.int64), *scores]),
            }
        )


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, owners: int = OWNERS, folder: str | None = None
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of each item.

    Scores are whole numbers above 0; equal ones are ranked by doc_id, nulls first, repeated
    doc_ids in the order of the table, row by row. Null and empty texts have no terms: such
    documents are not counted, such items have no rows. Rows that repeat an item_id are one item
    with the terms of all; a null item_id is an item. An empty table on either side gives no rows.
    Other columns are not read.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark)
    wanted = stored(item_terms(items), "wanted", folder)
    numbered = wanted.select("term").distinct().withColumn("id", F.monotonically_increasing_id())
    vocabulary = stored(numbered, "vocabulary", folder)
    counts, wide = term_counts(docs, vocabulary)
    counted = stored(counts, "counted", folder)
    rows, documents, length, pairs = counted.agg(
        F.count("*"), F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.size("terms")), F.lit(0))
    ).first()
    if not documents:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")

    shards = max(1, math.ceil(rows / SHARD_DOCUMENTS), math.ceil(pairs / SHARD_POSTINGS))
    in_shard = W.partitionBy("shard").orderBy(F.col("doc_id").asc_nulls_first(), "row")
    dealt = counted.where("n > 0").withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    placed = stored(dealt.withColumn("local", F.row_number().over(in_shard) - 1), "placed", folder)
    postings = _postings(placed, vocabulary, wide, documents, length)

    weight = F.floor(1000 * F.log(F.lit(2.0 * documents + 2) / (2 * F.col("df") + 1)))
    stats = postings.groupBy("id").agg(F.count("*").alias("df"), F.max("factor").alias("highest"))
    weighted = stored(stats.withColumn("weight", weight), "weighted", folder)
    borders = _borders(weighted, owners)
    owner = sum((F.when(F.col("weight") < b, 1).otherwise(0) for b in borders), F.lit(0)).cast("int")
    owned = stored(weighted.select("id", "weight", "highest", owner.alias("owner")), "owned", folder)

    routes = wanted.join(small(vocabulary), "term").join(small(owned), "id")
    term = F.struct("owner", "id", "weight", "highest")
    bundled = routes.groupBy("item_id").agg(F.sort_array(F.collect_list(term)).alias("t"))
    bundled = stored(bundled.withColumn("item", F.monotonically_increasing_id()), "items", folder)
    blocks = max(1, math.ceil(bundled.count() / BLOCK_ITEMS))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int")
    bundled = bundled.withColumn("block", block)
    nothing = F.lit(b"")
    bundles = bundled.select(
        "item", "block", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.col("t.owner").alias("owners"), F.col("t.id").alias("ids"), F.col("t.weight").alias("weights"),
        F.col("t.highest").alias("tops"), nothing.alias("places"), nothing.alias("scores"),
    )
    asked = bundled.select("block", F.explode("t").alias("t")).select("block", "t.owner", "t.id").distinct()
    asked = stored(asked, "asked", folder)
    for stage in range(owners):
        here = small(asked.where(F.col("owner") == stage).select("block", "id"))
        theirs = postings.join(here, "id").select("shard", "block", "id", "local", "factor")
        visit = _stage(stage, stage == owners - 1, top)
        met = bundles.groupBy("shard", "block").cogroup(theirs.groupBy("shard", "block"))
        bundles = stored(met.applyInPandas(visit, BUNDLE), f"stage_{stage}", folder)
    found = bundles.select("item", "shard", "places", "scores").mapInPandas(
        _unpacked, "item long, shard int, local int, score long"
    )
    known = found.join(placed.select("shard", "local", "doc_id", "row"), ["shard", "local"])
    by_score = W.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first(), "row")
    ranked = known.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= top)
    named = ranked.join(small(bundled.select("item", "item_id")), "item")
    return named.select("item_id", "rank", "doc_id", "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return search(read_documents(spark, sf_dir), items)


OP11_SQL = r"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY ALL),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM n),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY ALL),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark),
scored AS (
    SELECT item_id, doc_id, sum(
        floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT
        * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // len))))::BIGINT AS score
    FROM asked JOIN df USING (term) JOIN tf USING (term) JOIN n USING (doc_id) CROSS JOIN total
    GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 50
"""
