"""Mixing sources to target weights.

Words are summed per source; a water level over the sources' caps turns weights into targets; the repetition rate of
a source is its target over its size. A document is emitted floor(rate) times, plus once more by a hash-seeded draw
whose probability is the fraction. The draws of a source are dependent, which keeps its total near the target: its
documents form classes of nearly one size (two leading digits), and from the largest class down each gets the share of
the words still wanted among the words still to come, a number that is the fraction on average whatever came before.
Of that share of the class, rounded by a hash, the documents with the least hashes are drawn. Everything depends on
ids, sizes and the seed alone, so retried tasks, reruns and other partitionings emit the same copies.

Scale: texts are scanned once for their sizes, which are aggregated before the shuffle. The table of sources has one
row per source and is the only thing ranked as a whole; a source has some hundred classes. No class is ranked: counts
of hash cells, as many as the root of the class's rows, find the cell where the drawn ones end, and only that cell is
sorted. Joins are left to the optimizer's size checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.llm._shared import fresh, id_text, scratch, table, word_count, written

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
SEED = 42


def _unit(text: Column, seed: int) -> Column:
    """A number in [0, 1) from the first 52 bits of the MD5 of seed and text."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), text).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def draw(doc_id: Column, text: Column, seed: int) -> Column:
    """A document's number in [0, 1), by its id or, where it has none, by its text."""
    return _unit(F.coalesce(doc_id.cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))), seed)


def size_class(size: Column) -> Column:
    """The number of a size's digits and its first two, as an int that grows with the size."""
    printed = size.cast("string")
    return F.length(printed) * 100 + F.substring(F.rpad(printed, 2, "0"), 1, 2).cast("int")


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """sized(source, size) -> one row per source: source, source_size, weight, target, rate.

    Sources by code point, null last, weigh ``weights`` in turn; together they get ``share`` times all words, none
    more than ``most`` times its own. With sources in the order of cap over weight, the level that a source would set
    with all before it capped rises up to the true level and falls after it, so the level is the greatest of them.
    """
    sources = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = ((F.row_number().over(by_name) - 1) % len(weights)).cast("int")
    ranked = sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after, everything = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    level = (F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    leveled = ranked.withColumn("own", level).withColumn("level", F.max("own").over(everything))
    target = F.least(F.col("cap"), F.col("level") * F.col("weight"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return leveled.withColumn("target", target).withColumn("rate", rate).select("source", "source_size", "weight", "target", "rate")


def _class_draws(classes: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    """classes(source, class, n, words) and targets -> source, class, n, drawn: how many of a class are drawn (one fold per source)."""
    rounding = _unit(F.concat_ws(":", id_text(F.col("source")), F.col("class").cast("string")), seed)
    listed = classes.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("class", "n", "words", rounding.alias("u"))), asc=False).alias("classes"))
    renamed = targets.select(F.col("source").alias("of"), "source_size", "rate")
    known = listed.join(renamed, F.col("source").eqNullSafe(F.col("of")))
    fraction = F.col("rate") - F.floor("rate")
    start = F.struct((fraction * F.col("source_size")).alias("wanted"), F.col("source_size").cast("double").alias("left"), F.array().cast("array<struct<class:int,n:bigint,drawn:bigint>>").alias("done"))

    def step(at: Column, c: Column) -> Column:
        share = F.when(at["left"] > 0, F.least(F.greatest(at["wanted"] / at["left"], F.lit(0.0)), F.lit(1.0))).otherwise(fraction)
        drawn = F.floor(c["n"] * share + c["u"])
        return F.struct(
            (at["wanted"] - drawn * c["words"] / c["n"]).alias("wanted"),
            (at["left"] - c["words"]).alias("left"),
            F.concat(at["done"], F.array(F.struct(c["class"].alias("class"), c["n"].alias("n"), drawn.alias("drawn")))).alias("done"),
        )

    return known.select("source", F.explode(F.aggregate("classes", start, step)["done"]).alias("c")).select("source", "c.*")


def _limits(sized: DataFrame, drawn: DataFrame) -> DataFrame:
    """source, class, limit: a document of that class is drawn if its number is the limit at most (null: never).

    The limit is the greatest number that fewer than ``drawn`` of the class lie below.
    """
    renamed = written(drawn.withColumnRenamed("source", "of").withColumnRenamed("class", "in"), "mix-drawn")
    matches = F.col("source").eqNullSafe(F.col("of")) & (F.col("class") == F.col("in"))
    cell = F.floor(F.col("draw") * F.ceil(F.sqrt("n")))
    celled = sized.join(renamed.filter("drawn > 0"), matches).select("source", "class", "drawn", "draw", cell.alias("cell"))
    counts = celled.groupBy("source", "class", "drawn", "cell").agg(F.count("*").alias("here"))

    def last(rows: DataFrame, by: str, before: Column) -> DataFrame:
        """The last of each class's rows before which fewer than ``drawn`` come, with their number."""
        order = Window.partitionBy("source", "class").orderBy(by)
        summed = rows.withColumn("before", before + F.coalesce(F.sum("here").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        return summed.filter("before < drawn").groupBy("source", "class").agg(F.max(F.struct(by, "before")).alias("last"))

    ends = written(last(counts, "cell", F.lit(0)).select(F.col("source").alias("of"), F.col("class").alias("in"), "last.*"), "mix-cells")
    few = celled.join(ends.withColumnRenamed("cell", "end"), matches & (F.col("cell") == F.col("end"))).groupBy("source", "class", "drawn", "draw", "before").agg(F.count("*").alias("here"))
    return last(few, "draw", F.col("before")).select("source", "class", F.col("last.draw").alias("limit"))


def _plan(docs: DataFrame, weights, share: float, most: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """(source, class, source_size, target, rate, limit), and sized(doc_id, source, size, draw, class), both written."""
    size = word_count(F.col("text"))
    sized = docs.select("doc_id", "source", size.alias("size"), draw(F.col("doc_id"), F.col("text"), seed).alias("draw"))
    sized = written(sized.withColumn("class", size_class(F.col("size"))), "mix-sizes", keep=True)
    classes = written(sized.groupBy("source", "class").agg(F.count("*").alias("n"), F.sum("size").alias("words")), "mix-classes")
    targets = written(source_targets(classes.select("source", F.col("words").alias("size")), weights, share, most), "mix-targets")
    limits = _limits(sized, _class_draws(classes, targets, seed))
    each = classes.select(F.col("source").alias("of"), F.col("class").alias("in"))
    plan = each.join(limits, F.col("of").eqNullSafe(F.col("source")) & (F.col("in") == F.col("class")), "left").select("of", "in", "limit")
    plan = plan.join(targets, F.col("of").eqNullSafe(F.col("source"))).select("source", F.col("in").alias("class"), "source_size", "target", "rate", "limit")
    return written(plan, "mix-plan", keep=True), sized


def _copies(number: Column, rate: Column, limit: Column) -> Column:
    return F.floor(rate) + F.coalesce((number <= limit).cast("long"), F.lit(0))


def mix_plan(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """One row per document row: doc_id, source, size, source_size, target, copies.

    Null texts, texts without words and sources without words have size 0 and take no part in the sums; a source
    without words has target and rate 0. A null source is a source of its own, the last. Repeated rows count each;
    rows of one doc_id and size share their draw, as do rows without an id of one text. An empty table gives an empty
    plan. Extra columns are ignored.
    """
    with scratch(docs.sparkSession):
        plan, sized = _plan(docs, weights, share, most, seed)
    plan = plan.withColumnRenamed("source", "of").withColumnRenamed("class", "in")
    joined = sized.join(plan, F.col("source").eqNullSafe(F.col("of")) & (F.col("class") == F.col("in")))
    return joined.select("doc_id", "source", "size", "source_size", "target", _copies(F.col("draw"), F.col("rate"), F.col("limit")).alias("copies"))


def mix_sources(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """The mixed corpus: each row of docs, all columns kept, as often as the mix takes it (see mix_plan)."""
    with scratch(docs.sparkSession):
        plan, _ = _plan(docs, weights, share, most, seed)
    number, class_, of, in_, rate, limit, copy = fresh(docs.columns, "number", "class", "of", "in", "rate", "limit", "copy")
    marked = docs.withColumn(number, draw(F.col("doc_id"), F.col("text"), seed)).withColumn(class_, size_class(word_count(F.col("text"))))
    plan = plan.select(F.col("source").alias(of), F.col("class").alias(in_), F.col("rate").alias(rate), F.col("limit").alias(limit))
    joined = marked.join(plan, F.col("source").eqNullSafe(F.col(of)) & (F.col(class_) == F.col(in_)))
    copies = _copies(F.col(number), F.col(rate), F.col(limit)).cast("int")
    repeated = joined.withColumn(copy, F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies)).otherwise(F.array().cast("array<int>"))))
    return repeated.select(*docs.columns)


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    """Every document with its size, its source's size and target, and the words that the mix takes of it."""
    plan = mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP2_SQL = """
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^ \\t-\\r]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, 'null:' || md5(coalesce(text, '')))), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
  FROM documents
), classed AS (
  SELECT *, len(size::VARCHAR) * 100 + left(rpad(size::VARCHAR, 2, '0'), 2)::INTEGER AS class FROM sized
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight
  FROM sized GROUP BY source
), capped AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap FROM sources
), own AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
            / sum(weight) OVER (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS own
  FROM capped
), targets AS (
  SELECT source, source_size, least(cap, max(own) OVER () * weight) AS target FROM own
), rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate FROM targets
), classes AS (
  SELECT source, class, count(*)::DOUBLE AS n, sum(size)::DOUBLE AS words, row_number() OVER (PARTITION BY source ORDER BY class DESC) AS i,
         ('0x' || substr(md5('42:' || coalesce(source, 'null') || ':' || class), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM classed GROUP BY source, class
), steps AS (
  SELECT source, 0::BIGINT AS i, -1 AS class, 0.0::DOUBLE AS drawn, (rate - floor(rate)) * source_size AS wanted, source_size::DOUBLE AS remaining, rate - floor(rate) AS fraction FROM rates
  UNION ALL
  SELECT source, i, class, drawn, wanted - drawn * words / n, remaining - words, fraction
  FROM (SELECT c.*, s.wanted, s.remaining, s.fraction,
               floor(c.n * CASE WHEN s.remaining > 0 THEN least(greatest(s.wanted / s.remaining, 0.0::DOUBLE), 1.0::DOUBLE) ELSE s.fraction END + c.u) AS drawn
        FROM steps s JOIN classes c ON c.source IS NOT DISTINCT FROM s.source AND c.i = s.i + 1)
), ranked AS (
  SELECT *, rank() OVER (PARTITION BY source, class ORDER BY draw) AS place FROM classed
)
SELECT k.doc_id, k.size, r.source_size, r.target, (k.size * (floor(r.rate)::BIGINT + CASE WHEN k.place <= s.drawn THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ranked k JOIN rates r ON k.source IS NOT DISTINCT FROM r.source JOIN steps s ON s.source IS NOT DISTINCT FROM k.source AND s.class = k.class
"""
