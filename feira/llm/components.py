"""Connected components of a graph given as a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feira.llm.common import stored


def components(links: DataFrame, folder: str) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b: long); component is the
    smallest node that can be reached.

    Large-star and small-star steps in turn: every node's larger neighbours, then its smaller
    ones, are linked to the smallest. Nothing but links moves, minima are formed per task
    before a shuffle, and a hub's links are split because both sides of each join come from
    stored tables. Each step is stored in ``folder``, so a lost executor costs one step. The
    number of steps grows with the logarithm of the longest chain.
    """
    step = 0
    current = stored(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links_0",
        folder,
    )
    while True:
        step += 1
        # large star: neighbours above a node get the smallest of the node's neighbourhood
        both = current.union(current.select("b", "a"))
        lowest = both.groupBy("a").agg(F.min("b").alias("m"))
        lowest = stored(
            lowest.select(F.col("a").alias("k"), F.least("a", "m").alias("m")), f"large_{step}", folder
        )
        large = both.join(lowest, F.col("a") == F.col("k")).where("b > a")
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, f"large_links_{step}", folder)
        # small star: a node and its smaller neighbours get the smallest of them
        lowest = stored(
            large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k"), f"small_{step}", folder
        )
        small = large.join(lowest, F.col("a") == F.col("k")).where("b != m")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(lowest.select(F.col("k").alias("a"), F.col("m").alias("b"))).distinct()
        small = stored(small, f"links_{step}", folder)
        changed = small.exceptAll(current).isEmpty() and small.count() == current.count()
        current = small
        if changed:
            break
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
