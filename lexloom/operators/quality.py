"""Evaluation against expected sets: true and false positives, ratios from summed counts, gates, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions.text import safe_ratio


def confusion(expected: DataFrame, actual: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Per group: tp, fp, fn over the distinct keys of two sets."""
    both = expected.select(*by, *keys).distinct().withColumn("e", F.lit(1)).join(actual.select(*by, *keys).distinct().withColumn("a", F.lit(1)), [*by, *keys], "full_outer")
    e, a = F.col("e").isNotNull(), F.col("a").isNotNull()
    return both.groupBy(*by).agg(F.count_if(e & a).alias("tp"), F.count_if(~e & a).alias("fp"), F.count_if(e & ~a).alias("fn"))


def micro(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """tp, fp, fn summed, then precision and recall with 0/0 = 1."""
    sums = counts.groupBy(*(by or [])).agg(*[F.sum(c).cast("long").alias(c) for c in ("tp", "fp", "fn")])
    return sums.withColumn("precision", safe_ratio(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", safe_ratio(F.col("tp"), F.col("tp") + F.col("fn")))


def exact_rate(df: DataFrame, equal: Column, name: str) -> DataFrame:
    """Share of rows for which a null-safe comparison holds; 1 for none (A10)."""
    return df.agg(safe_ratio(F.count_if(equal), F.count("*")).alias(name))


def gate(metrics: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """metrics with passed: every named metric reaches its threshold."""
    passed = F.lit(True)
    for name, least in thresholds.items():
        passed = passed & (F.col(name) >= least)
    return metrics.withColumn("passed", passed)


def coverage(tagged: DataFrame, tag: str, targets: DataFrame) -> DataFrame:
    """targets(tag, target) with count and remaining, most remaining first."""
    counts = tagged.groupBy(tag).agg(F.count("*").alias("n"))
    out = targets.join(counts, tag, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return out.withColumn("remaining", F.greatest(F.lit(0), F.col("target") - F.col("n")).cast("long")).orderBy(F.col("remaining").desc(), tag)


def top_values(df: DataFrame, column: str, n: int = 25) -> DataFrame:
    """The n most frequent values, ties by value."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), column).limit(n)
