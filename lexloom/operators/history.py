"""Reviewed edits and dated linear histories: single replacements, chain checks, the state as of a date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def occurrences(text: Column, part: Column) -> Column:
    """How often a part occurs in a text, not overlapping; null for an empty part."""
    return F.try_divide(F.length(text) - F.length(F.replace(text, part, F.lit(""))), F.length(part)).cast("int")


def text_digest(text: Column) -> Column:
    """SHA-256 of white-space-collapsed text."""
    return F.sha2(F.trim(F.regexp_replace(text, "\\s+", " ")), 256)


def previews(plans: DataFrame, bodies: DataFrame) -> DataFrame:
    """plans(preview_id, section, old, new, body_sha256, operative_date) on bodies(section, body).

    Adds preview, the edited text, where the old wording occurs exactly once in the body that was reviewed, and
    problem, the first reason why not.
    """
    joined = plans.join(bodies, "section", "left").withColumn("_n", occurrences(F.col("body"), F.col("old")))
    problem = (
        F.when(F.col("body").isNull(), "missing-section")
        .when(text_digest(F.col("body")) != F.col("body_sha256"), "body-changed")
        .when(F.col("operative_date").isNull(), "no-operative-date")
        .when(F.coalesce("_n", F.lit(0)) != 1, "not-exactly-once")
    )
    out = joined.withColumn("problem", problem)
    return out.withColumn("preview", F.when(F.col("problem").isNull(), F.replace("body", "old", "new"))).drop("_n")


def chain_problems(plans: DataFrame, spark: SparkSession) -> DataFrame:
    """(preview_id, problem) of histories that aren't linear: duplicate, missing-predecessor, branch, order, cycle."""
    p = plans.select("preview_id", "predecessor", "section", "operative_date")
    dup = p.groupBy("preview_id").agg(F.count("*").alias("n")).filter("n > 1").select("preview_id", F.lit("duplicate").alias("problem"))
    known = p.select(F.col("preview_id").alias("predecessor"), F.col("section").alias("s0"), F.col("operative_date").alias("d0"))
    linked = p.filter("predecessor is not null").join(known, "predecessor", "left")
    missing = linked.filter("s0 is null").select("preview_id", F.lit("missing-predecessor").alias("problem"))
    order = linked.filter("s0 <> section or d0 > operative_date").select("preview_id", F.lit("order").alias("problem"))
    branch = p.filter("predecessor is not null").groupBy("predecessor").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("predecessor").alias("preview_id"), F.lit("branch").alias("problem"))
    p.distinct().createOrReplaceTempView("_lexloom_plans")
    reached = spark.sql("""
        WITH RECURSIVE r(preview_id) AS (
          SELECT preview_id FROM _lexloom_plans WHERE predecessor IS NULL OR predecessor NOT IN (SELECT preview_id FROM _lexloom_plans)
          UNION ALL SELECT p.preview_id FROM _lexloom_plans p JOIN r ON p.predecessor = r.preview_id
        ) SELECT DISTINCT preview_id FROM r""")
    cycle = p.join(reached, "preview_id", "left_anti").select("preview_id", F.lit("cycle").alias("problem"))
    return dup.union(missing).union(order).union(branch).union(cycle).distinct()


def as_of(plans: DataFrame, bodies: DataFrame, date: str, spark: SparkSession) -> DataFrame:
    """section, body, n_applied: each section's text with its history's edits up to and including a date."""
    plans.createOrReplaceTempView("_lexloom_plans")
    bodies.createOrReplaceTempView("_lexloom_bodies")
    chain = spark.sql(f"""
        WITH RECURSIVE h(section, preview_id, body, depth) AS (
          SELECT section, CAST(NULL AS STRING), body, 0 FROM _lexloom_bodies
          UNION ALL
          SELECT h.section, p.preview_id, replace(h.body, p.old, p.new), h.depth + 1
          FROM h JOIN _lexloom_plans p ON p.section = h.section AND p.predecessor <=> h.preview_id AND p.operative_date <= DATE'{date}'
        ) SELECT section, body, depth FROM h""")
    return chain.groupBy("section").agg(F.max_by("body", "depth").alias("body"), F.max("depth").alias("n_applied"))


def catalog(references: DataFrame, plans: DataFrame, date: str) -> DataFrame:
    """references(section, reference_id) with status needs-text-review, scheduled or applied as of a date."""
    planned = plans.select("reference_id", "operative_date")
    status = F.when(F.col("operative_date").isNull(), "needs-text-review").when(F.col("operative_date") <= F.lit(date).cast("date"), "applied").otherwise("scheduled")
    return references.join(planned, "reference_id", "left").withColumn("status", status)
