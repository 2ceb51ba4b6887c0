from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    first, *others = parts
    for other in others:
        first = first.unionByName(other)
    return first


def row_audit(tables: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Rows in, kept and dropped per table, from ``{name: (before, after)}``.

    Over stored Parquet both counts come from file footers, so auditing a finished
    layer reads no data pages. Counting what was stored is also exact when a task or
    a whole stage had to run again, which counters inside the write job are not.
    """
    counts = []
    for name, (before, after) in tables.items():
        for df, column in ((before, "rows_in"), (after, "rows_out")):
            counts.append(
                df.agg(F.count(F.lit(1)).alias("n")).select(
                    F.lit(name).alias("table_name"),
                    F.lit(column).alias("side"),
                    "n",
                )
            )
    rows_in = F.sum(F.when(F.col("side") == "rows_in", F.col("n")).otherwise(0))
    rows_out = F.sum(F.when(F.col("side") == "rows_out", F.col("n")).otherwise(0))
    return (
        _union(counts)
        .groupBy("table_name")
        .agg(rows_in.alias("rows_in"), rows_out.alias("rows_out"))
        .withColumn("rows_dropped", F.col("rows_in") - F.col("rows_out"))
    )


def orphans(links: Iterable[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Rows of a child table whose key has no parent, per link.

    Each link is ``(child name, child, parent name, parent, key)``; tables are told by their
    names. A null key counts as an orphan. All tables that take part in links on one key are
    laid together and grouped by it once, whatever the number of links: children are counted,
    and parents set a flag. Each task sends one row per key, so a key that a large part of a
    child table has in common is no hot group.
    """
    by_key: dict[str, list] = {}
    for link in links:
        by_key.setdefault(link[4], []).append(link)
    reports = [_orphans_by(key, own) for key, own in by_key.items()]
    return _union(reports)


def _orphans_by(key: str, links: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    children = {name: table for name, table, *_ in links}
    parents = {name: table for _, _, name, table, _ in links}
    child_of = {name: i for i, name in enumerate(children)}
    flag_of = {name: 1 << i for i, name in enumerate(parents)}
    sides = [
        df.select(F.col(key).alias("key"), F.lit(child_of[name]).alias("child"), F.lit(0).cast("long").alias("flags"))
        for name, df in children.items()
    ]
    sides += [
        df.select(F.col(key).alias("key"), F.lit(-1).alias("child"), F.lit(flag_of[name]).cast("long").alias("flags"))
        for name, df in parents.items()
    ]
    counts = [F.count_if(F.col("child") == i).alias(f"n{i}") for i in child_of.values()]
    per_key = _union(sides).groupBy("key").agg(*counts, F.bit_or("flags").alias("flags"))
    found = []
    for child_name, _, parent_name, _, _ in links:
        n = F.col(f"n{child_of[child_name]}")
        missing = F.col("key").isNull() | (F.col("flags").bitwiseAND(flag_of[parent_name]) == 0)
        found.append(
            F.struct(
                F.lit(child_name).alias("child_table"),
                F.lit(parent_name).alias("parent_table"),
                F.lit(key).alias("key_column"),
                F.coalesce(F.sum(F.when(missing, n)), F.lit(0)).alias("orphan_rows"),
                F.count_if(missing & (n > 0)).alias("orphan_keys"),
            )
        )
    return per_key.agg(F.array(*found).alias("links")).select(F.inline("links"))


def dropped_by_rule(
    df: DataFrame,
    rules: Mapping[str, Column],
    keys: Sequence[str] = (),
    picked: Sequence[str] | None = None,
    later_rules: Mapping[str, Column] | None = None,
    copies: str = "copy",
) -> DataFrame:
    """Rows of a table that each rule drops: ``rule``, ``rows_dropped``.

    ``rules`` say what a row must fulfil (null is no). Of the rows that pass, one stays for
    each of ``keys``, if there are any: the smallest by ``picked`` (all other columns unless
    told otherwise). Others count as copies. ``later_rules`` look at the rows that stay. A row
    counts for the first rule that it fails, so the numbers add up to all rows dropped.

    Failed rules are bits of a mask, and everything is counted in one grouping by the keys.
    """
    later = dict(later_rules or {})
    failed = [F.when(F.coalesce(kept, F.lit(False)), 0).otherwise(1 << i) for i, kept in enumerate(rules.values())]
    mask = sum((f.cast("long") for f in failed), F.lit(0).cast("long"))
    masked = df.withColumn("_failed", mask)
    first = F.col("_failed").bitwiseAND(-F.col("_failed"))  # the lowest bit that is set
    by_rule = [F.count_if(first == (1 << i)).alias(f"_rule{i}") for i in range(len(rules))]
    passing = F.col("_failed") == 0
    if keys:
        rest = list(picked) if picked is not None else [c for c in df.columns if c not in keys]
        row = F.struct(*rest) if rest else F.lit(True)
        per_key = masked.groupBy(*keys).agg(
            *by_rule, F.count_if(passing).alias("_passing"), F.min(F.when(passing, row)).alias("_kept")
        )
        stays = F.col("_kept").isNotNull()
        per_key = per_key.select("*", *([] if not rest else [F.col(f"_kept.{c}").alias(c) for c in rest if c not in keys]))
        late = [F.when(F.coalesce(kept, F.lit(False)), 0).otherwise(1 << i) for i, kept in enumerate(later.values())]
        late_mask = sum((f.cast("long") for f in late), F.lit(0).cast("long"))
        per_key = per_key.withColumn("_late", F.when(stays, late_mask).otherwise(0))
        first_late = F.col("_late").bitwiseAND(-F.col("_late"))
        numbers = [F.sum(f"_rule{i}") for i in range(len(rules))]
        numbers.append(F.sum(F.col("_passing") - F.when(stays, 1).otherwise(0)))
        numbers += [F.count_if(first_late == (1 << i)) for i in range(len(later))]
        totals, names = per_key, [*rules, copies, *later]
    else:
        totals, numbers, names = masked, by_rule, list(rules)
    counted = [
        F.struct(F.lit(name).alias("rule"), F.coalesce(n, F.lit(0)).cast("long").alias("rows_dropped"))
        for name, n in zip(names, numbers, strict=True)
    ]
    return totals.agg(F.array(*counted).alias("found")).select(F.inline("found"))


def rule_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``dropped_by_rule`` of several tables as one: ``table_name``, ``rule``, ``rows_dropped``."""
    return _union(
        found.select(F.lit(name).alias("table_name"), "rule", "rows_dropped") for name, found in tables.items()
    )
