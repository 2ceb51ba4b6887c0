"""Mixing sources to target weights, with DataFrame functions only.

The words of a source, document after document, are packed into blocks of fixed length. The
output has shards of slots. Each shard draws how many of its slots go to which source; the
slots of a source are numbered over all shards, and a pseudorandom permutation of the source's
block numbers, a new one for every pass over the source, says which block a slot holds. A join
by block number brings the blocks, and so the documents, to the slots.

A shard's counts are a stratified multinomial draw: the whole part of each expected count is
fixed, and the slots left over are drawn with the remaining probabilities. A plain multinomial
draw has the same mean and strays further from it.
"""

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feira.llm.common import WORD, read_documents, small, stored
from feira.sources.working import new_folder

# Weights of the sources in the order of their names, repeating.
WEIGHTS = 3
MAX_REPEATS = 3
BLOCK_WORDS = 64
SHARD_SLOTS = 65_536
SEED = 20

ROW = "_feira_row"
# A walk leaves the numbers above the block count after two steps on average; few need more
# than the first steps, and none more than all.
_FIRST_STEPS, _MORE_STEPS = 3, 60


def sized(docs: DataFrame) -> DataFrame:
    """row, doc_id, source, size in words and a hash of the text to break ties."""
    row = F.col(ROW) if ROW in docs.columns else F.monotonically_increasing_id()
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        row.alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(text).alias("tie"),
    )


def targets(rows: DataFrame) -> DataFrame:
    """One row per source: sid, source, source_size, blocks, target and expected slots.

    Sources above their limit get the limit; the others share what is left by weight. With
    sources ordered by limit per weight, those limited come first, so running sums find where
    the limits end. The windows run over sources, not documents.
    """
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(F.asc_nulls_last("source"))
    limit = MAX_REPEATS * F.col("source_size")
    known = sums.select(
        (F.row_number().over(order) - 1).alias("sid"),
        "source",
        "source_size",
        limit.alias("limit"),
        F.sum("source_size").over(everything).alias("total"),
    ).withColumn("weight", F.col("sid") % WEIGHTS + 1)
    ratio = F.col("limit") / F.col("weight")
    before = Window.orderBy("ratio", "sid").rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy("ratio", "sid").rowsBetween(0, Window.unboundedFollowing)
    left = F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0))
    level = known.withColumn("ratio", ratio).withColumn(
        "level", left / F.sum("weight").over(onward)
    )
    fits = F.when(F.col("level") <= F.col("ratio"), F.col("ratio"))
    unit = F.min_by("level", F.struct(fits.isNull(), "ratio", "sid")).over(everything)
    target = F.least(F.col("limit").cast("double"), unit * F.col("weight"))
    blocks = F.ceil(F.col("source_size") / F.lit(BLOCK_WORDS)).cast("long")
    return level.select(
        "sid",
        "source",
        "source_size",
        blocks.alias("blocks"),
        target.alias("target"),
        F.when(F.col("source_size") > 0, target * blocks / F.col("source_size"))
        .otherwise(0.0)
        .alias("expected"),
    )


def _uniform(*parts: Column) -> Column:
    """A number from 0 up to 1 that is a function of ``parts``."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *parts), 11) / F.lit(float(1 << 53))


def shard_counts(sources: DataFrame) -> DataFrame:
    """(shard, sid, slots): how many slots of each shard go to each source."""
    total = sources.agg(F.ceil(F.round(F.sum("expected"), 6)).cast("long")).scalar()
    all_slots = sources.sparkSession.range(1).select(F.coalesce(total, F.lit(0)).alias("n"))
    shards = all_slots.select(
        "n",
        F.explode(
            F.when(
                F.col("n") > 0,
                F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / SHARD_SLOTS) - 1),
            )
        ).alias("shard"),
    ).select("shard", F.least(F.lit(SHARD_SLOTS), F.col("n") - F.col("shard") * SHARD_SLOTS).alias("size"))
    shares = sources.agg(
        F.sort_array(F.collect_list(F.struct("sid", "expected"))).alias("s")
    ).select(
        F.transform(
            "s",
            lambda x: F.struct(
                x["sid"].alias("sid"),
                F.coalesce(F.try_divide(x["expected"], _sum("s.expected")), F.lit(0.0)).alias("p"),
            ),
        )
    )
    per_shard = shards.withColumn("shares", shares.scalar())
    fixed = per_shard.select("shard", "size", F.explode("shares").alias("x")).select(
        "shard", F.col("x.sid").alias("sid"), F.floor(F.col("size") * F.col("x.p")).alias("slots")
    )
    rests = F.transform("shares", lambda x: F.col("size") * x["p"] - F.floor(F.col("size") * x["p"]))
    count = F.round(_sum("rests")).cast("int")
    draws = (
        per_shard.withColumn("rests", rests)
        .select("shard", "shares", "rests", F.explode(F.when(count > 0, F.sequence(F.lit(1), count))).alias("draw"))
        .withColumn("point", _uniform(F.col("shard"), F.col("draw")) * _sum("rests"))
    )
    # the first source up to which the remaining parts add to more than the point
    running = F.aggregate(
        "rests",
        F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("passed")),
        lambda a, x: F.struct(
            (a["sum"] + x).alias("sum"),
            (a["passed"] + (a["sum"] + x <= F.col("point")).cast("int")).alias("passed"),
        ),
    )["passed"]
    drawn = draws.select(
        "shard", F.get("shares", F.least(running, F.size("shares") - 1))["sid"].alias("sid"), F.lit(1).cast("long").alias("slots")
    )
    return fixed.union(drawn).groupBy("shard", "sid").agg(F.sum("slots").alias("slots"))


def _sum(column: str) -> Column:
    return F.aggregate(column, F.lit(0.0), lambda a, x: a + x)


def permuted(number: Column, count: Column, *keys: Column) -> Column:
    """Where a pseudorandom permutation of 0 .. count - 1, chosen by ``keys``, sends a number.

    Four Feistel rounds permute the numbers of h bits, the least power of two (of four at
    least) that reaches the count; who lands outside walks on. The walk stays on the cycle
    that it began on, so it comes back inside, and different numbers end at different places.
    """
    bits = F.greatest(F.lit(2), F.ceil(F.log2(count.cast("double"))).cast("int"))
    low = F.floor(bits / 2).cast("int")
    # two's powers by doubles are exact here: far fewer than 53 bits
    low_size, high_size = F.pow(F.lit(2.0), low).cast("long"), F.pow(F.lit(2.0), bits - low).cast("long")

    def noise(part: Column, turn: int, size: Column) -> Column:
        return F.xxhash64(F.lit(SEED + turn), part, *keys).bitwiseAND(size - 1)

    def rounds(x: Column) -> Column:
        high, right = F.floor(x / low_size), x.bitwiseAND(low_size - 1)
        for turn in (1, 3):
            high = high.bitwiseXOR(noise(right, turn, high_size))
            right = right.bitwiseXOR(noise(high, turn + 1, low_size))
        return high * low_size + right

    def walked(x: Column, steps: int) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(steps)),
            x,
            lambda y, _: F.when(y < count, y).otherwise(rounds(y)),
        )

    begun = F.array(walked(rounds(number), _FIRST_STEPS))
    return F.transform(
        begun, lambda x: F.when(x < count, x).otherwise(walked(x, _MORE_STEPS))
    )[0]


def slots(sources: DataFrame, folder: str) -> DataFrame:
    """(shard, sid, pass, block) for every slot of the output."""
    counts = stored(shard_counts(sources), "shard_counts", folder)
    earlier = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("slots").over(earlier), F.lit(0))
    ranges = counts.where("slots > 0").withColumn("start", start)
    known = ranges.join(small(sources.select("sid", "blocks")), "sid")
    # no source is passed over more than MAX_REPEATS times
    last = F.least(F.col("start") + F.col("slots"), F.col("blocks") * MAX_REPEATS) - 1
    # few rows become many: spread them over the cluster, whatever their own size
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = known.where(F.col("start") <= last).repartition(tasks, "shard", "sid")
    numbered = spread.select(
        "shard", "sid", "blocks", F.explode(F.sequence("start", last)).alias("slot")
    )
    turn = F.floor(F.col("slot") / F.col("blocks"))
    block = permuted(F.col("slot") % F.col("blocks"), F.col("blocks"), F.col("sid"), turn)
    return numbered.select("shard", "sid", turn.alias("pass"), block.alias("block"))


def packed(rows: DataFrame, sources: DataFrame, folder: str) -> DataFrame:
    """Rows with the word at which they begin in their source, in an order set by hashes.

    Running sums in two levels: rows are dealt to about as many buckets as a bucket has rows,
    first the buckets' sums are added up per source, then the rows within each bucket, so no
    window sees a whole source.
    """
    buckets = max(1, math.ceil(math.sqrt(rows.count())))
    keyed = rows.join(
        small(sources.select("sid", F.col("source").alias("_source"))),
        F.col("source").eqNullSafe(F.col("_source")),
    ).select(
        "row", "doc_id", "sid", "size", "tie",
        F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(buckets)).alias("bucket"),
    )
    sums = keyed.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(
        sums.select("sid", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("bucket_start")),
        "bucket_starts",
        folder,
    )
    within = Window.partitionBy("sid", "bucket").orderBy("doc_id", "size", "tie", "row").rowsBetween(Window.unboundedPreceding, -1)
    inner = keyed.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    return inner.join(small(starts), ["sid", "bucket"]).select(
        "row", "doc_id", "sid", "size", (F.col("bucket_start") + F.col("inner")).alias("start")
    )


def pieces(rows: DataFrame, sources: DataFrame, folder: str) -> DataFrame:
    """Rows cut at block ends: row, doc_id, sid, size, block, words.

    One for no words, with a negative block of its own: a shuffle by block spreads those too.
    """
    placed = packed(rows, sources, folder)
    end, any_words = F.col("start") + F.col("size"), F.col("size") > 0
    first, last = F.floor(F.col("start") / BLOCK_WORDS), F.floor((end - 1) / BLOCK_WORDS)
    cut = placed.withColumn(
        "block", F.explode(F.when(any_words, F.sequence(first, last)).otherwise(F.array(-1 - F.col("row"))))
    )
    begin = F.greatest("start", F.col("block") * BLOCK_WORDS)
    stop = F.least(end, (F.col("block") + 1) * BLOCK_WORDS)
    words = F.when(any_words, stop - begin).otherwise(0)
    return cut.select("row", "doc_id", "sid", "size", "block", words.alias("words"))


def mixture(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """One row per document: row, doc_id, size, source_size, target, taken.

    ``taken`` is how many of its words the mix has, repeats counted. A null text has no words,
    a null source is a source and comes last, a null doc_id sorts first. Documents that repeat
    a doc_id are different documents. An empty table, or one without words, gives targets of
    zero. Reruns agree, whatever the layout of the files. Other columns are not read.
    """
    folder = folder or new_folder(docs.sparkSession)
    rows = stored(sized(docs), "sizes", folder)
    sources = stored(targets(rows), "sources", folder)
    drawn = slots(sources, folder).groupBy("sid", "block").agg(F.count("*").alias("times"))
    # The blocks drawn grow with the input, but adaptive execution judges them by the few ranges
    # that they come from: without the hint it may broadcast them all through the driver.
    taken = (
        pieces(rows, sources, folder)
        .join(drawn.hint("merge"), ["sid", "block"], "left")
        .groupBy("row", "doc_id", "sid", "size")
        .agg(F.sum(F.coalesce(F.col("words") * F.col("times"), F.lit(0))).alias("taken"))
    )
    return taken.join(small(sources.select("sid", "source_size", "target")), "sid").select(
        "row", "doc_id", "size", "source_size", "target", "taken"
    )


def repeat_by_mixture(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """``docs``, each as often as the mix takes it; documents that it does not take go.

    A document of which part is taken once more than the rest is repeated once more with the
    probability of that part, by a hash of its doc_id.
    """
    folder = folder or new_folder(docs.sparkSession)
    numbered = stored(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered", folder)
    share = F.col("taken") / F.col("size")
    more = _uniform(F.col("doc_id"), F.col("size")) < share - F.floor(share)
    times = mixture(numbered, folder).where("taken > 0").select(
        F.col("row").alias(ROW), (F.floor(share) + more.cast("int")).cast("int").alias("_feira_times")
    )
    times = stored(times.where("_feira_times > 0"), "times", folder)
    repeated = numbered.join(small(times), ROW).withColumn(
        "_feira_copy", F.explode(F.sequence(F.lit(1), F.col("_feira_times")))
    )
    return repeated.select(*docs.columns)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(read_documents(spark, sf_dir)).drop("row")
