"""Relational operators: as-of and range joins, diffs, reconciliation, integrity, histories.

Keys are hash-partitioned and windows run per key, so nothing here orders a whole table; small sides are left to the
optimizer's own size checks.
"""

from __future__ import annotations

import tempfile
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_backward(df: DataFrame, keys: list[str], order: list[str], is_anchor: Column, value: str, name: str) -> DataFrame:
    """df with ``name``: ``value`` of the nearest anchor row strictly before each row, by key and order."""
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.last(F.when(is_anchor, F.col(value)), ignorenulls=True).over(before))


def span_end(df: DataFrame, keys: list[str], order: list[str], closes: Column, at: str, name: str) -> DataFrame:
    """df with ``name``: ``at`` of the first later row that closes spans, by key and order; null if none does."""
    after = Window.partitionBy(*keys).orderBy(*order).rowsBetween(1, Window.unboundedFollowing)
    return df.withColumn(name, F.first(F.when(closes, F.col(at)), ignorenulls=True).over(after))


def range_lookup(df: DataFrame, value: str, ranges: DataFrame, low: str, high: str, rank: str, take: list[str]) -> DataFrame:
    """df with the columns ``take`` of the first range, by ``rank``, whose bounds enclose ``value``; null if none.

    ranges is a declared list (a roster). Each distinct value meets it once; the rows then join by the value itself.
    """
    values = df.select(value).distinct()
    hits = values.join(ranges, (F.col(value) >= F.col(low)) & (F.col(value) <= F.col(high)))
    first = hits.groupBy(value).agg(F.min_by(F.struct(*take), rank).alias("_first"))
    return df.join(first, value, "left").select(*df.columns, *[F.col(f"_first.{c}").alias(c) for c in take])


def edition_diff(before: DataFrame, after: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, status (added, removed, changed, unchanged) and the changed fields' names, comma-joined."""
    left = before.select(key, F.struct(*fields).alias("b"))
    right = after.select(key, F.struct(*fields).alias("a"))
    both = left.join(right, key, "full_outer")
    changed = F.filter(F.array(*[F.when(~F.col(f"b.{f}").eqNullSafe(F.col(f"a.{f}")), F.lit(f)) for f in fields]), lambda x: x.isNotNull())
    two = F.col("b").isNotNull() & F.col("a").isNotNull()
    status = (
        F.when(F.col("b").isNull(), "added").when(F.col("a").isNull(), "removed").when(F.size(changed) > 0, "changed").otherwise("unchanged")
    )
    return both.select(key, status.alias("status"), F.when(two, F.array_join(changed, ",")).otherwise(F.lit("")).alias("changed_fields"))


def diff_conserves(diff: DataFrame) -> DataFrame:
    """One row of counts per status, and whether before = removed + changed + unchanged."""
    n = {s: F.count_if(F.col("status") == s) for s in ("added", "removed", "changed", "unchanged")}
    return diff.agg(*[v.alias(k) for k, v in n.items()])


def first_per(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in the given order."""
    ranked = df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_n = 1").drop("_n")


def ordinals(df: DataFrame, keys: list[str], order: list[Column | str], name: str, start: int = 0) -> DataFrame:
    """df numbered by key in the given order."""
    return df.withColumn(name, (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1 + start).cast("long"))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that several rows have, and how many."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def missing_parent(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows of child whose key is set and absent from parent."""
    return child.filter(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")


def violations(rules: list[tuple[str, DataFrame, Column]]) -> DataFrame:
    """(rule, row_key) over all rules' offending rows."""
    return reduce(DataFrame.unionByName, [df.select(F.lit(rule).alias("rule"), key.cast("string").alias("row_key")) for rule, df, key in rules])


def chain_depths(edges: DataFrame, node: str, parent: str, spark) -> DataFrame:
    """(node, root, depth) of a forest of predecessor edges; nodes of cycles and with a missing predecessor don't appear.

    By doubling: each round every pointer leaps to where the node it points at points, so a chain of n steps takes
    log2(n) rounds. A chain has nodes of every depth, so a round that closes no pointer has only cycles left.
    """
    root = F.col(parent).isNull()
    jumps = edges.select(F.col(node).alias("node"), F.col(parent).alias("at"), F.when(root, 0).otherwise(1).alias("depth"), F.when(root, F.col(node)).alias("last"))
    left, before = None, None
    while left is None or left and left != before:
        # lineage ends with every round
        jumps, before = without_lineage(jumps), left
        left = jumps.filter("at is not null").count()
        ahead = jumps.select(F.col("node").alias("at"), F.col("at").alias("next"), F.col("depth").alias("more"), F.col("last").alias("end"))
        leapt = jumps.filter("at is not null").join(ahead, "at").select("node", F.col("next").alias("at"), (F.col("depth") + F.col("more")).alias("depth"), F.col("end").alias("last"))
        jumps = jumps.filter("at is null").unionByName(leapt)
    return jumps.filter("at is null").select("node", F.col("last").alias("root"), "depth")


def shared_folder(spark) -> str:
    """The folder that the session names for what outlives a job; a local session without one gets a folder of its machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="lexloom-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def without_lineage(df: DataFrame) -> DataFrame:
    """df from a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def linear_history(df: DataFrame, keys: list[str], order: list[str], step: str) -> DataFrame:
    """df with root, the first step of each key's history in order, and depth, the steps up to here."""
    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("root", F.first(step).over(upto)).withColumn("depth", F.count("*").over(upto))


def all_matched(parents: DataFrame, key: str, children: DataFrame, matched: Column) -> DataFrame:
    """key, n_children, status: resolved if a key has children and all match, else unresolved."""
    rolled = children.groupBy(key).agg(F.count("*").alias("n_children"), F.bool_and(matched).alias("_all"))
    joined = parents.join(rolled, key, "left")
    return joined.select(*parents.columns, F.coalesce("n_children", F.lit(0)).alias("n_children"), F.when(F.col("_all"), "resolved").otherwise("unresolved").alias("status"))


def field_changes(before: DataFrame, after: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, field, before_value, after_value of every field that differs between rows of both sides."""
    both = before.select(key, F.struct(*fields).alias("b")).join(after.select(key, F.struct(*fields).alias("a")), key)
    items = [F.when(~F.col(f"b.{f}").eqNullSafe(F.col(f"a.{f}")), F.struct(F.lit(f).alias("field"), F.col(f"b.{f}").cast("string").alias("before_value"), F.col(f"a.{f}").cast("string").alias("after_value"))) for f in fields]
    return both.select(key, F.explode(F.array_compact(F.array(*items))).alias("c")).select(key, "c.*")


def nested(parents: DataFrame, key: str, children: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """parents with one array of structs per child table, each in the order of its first columns."""
    out = parents
    for name, (child, columns) in children.items():
        out = out.join(child.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias(name)), key, "left")
    return out
