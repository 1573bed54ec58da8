"""Queries that bind the library's operators to the driver's tables, each with its DuckDB equivalent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions import keys, text
from lexloom.operators import markup, quality, relational, search
from lexloom.sources import files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function (t, spark) -> DataFrame, where t(name) reads a table."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark)

        run.__doc__, run.__name__ = function.__doc__, function.__name__
        QUERIES[function.__name__] = run
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def _sections(t) -> DataFrame:
    """documents as sections: the first line is the catchline, the rest the content."""
    return t("documents").select(
        "doc_id",
        "lang",
        "source",
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("catchline"),
        F.regexp_replace("text", "^[^\n]*\n?", "").alias("content"),
    )


_SECTIONS = "SELECT doc_id, lang, source, split_part(text, chr(10), 1) AS catchline, regexp_replace(text, '^[^\\n]*\\n?', '') AS content FROM documents"
_FOLD = f"translate(lower({{}}), '{text.ACCENTED}', '{text.PLAIN}')"
_TOKENS = "regexp_extract_all(" + _FOLD + ", '[\\p{{L}}\\p{{N}}]+')"


def _bm25_sql(terms: list[str], tail: str, keep: str = "doc_id, lang, source", rounded: bool = True) -> str:
    tf = [f"5.0 * len(list_filter(tc, lambda x: x = '{w}')) + 1.0 * len(list_filter(tb, lambda x: x = '{w}'))" for w in terms]
    columns = ", ".join(f"({x})::DOUBLE AS tf{i}" for i, x in enumerate(tf))
    df = ", ".join(f"count(*) FILTER (WHERE tf{i} > 0) AS df{i}" for i in range(len(terms)))
    part = " + ".join(
        f"(CASE WHEN ln((n - df{i} + 0.5) / (df{i} + 0.5)) <= 0 THEN 1e-6 ELSE ln((n - df{i} + 0.5) / (df{i} + 0.5)) END) * tf{i} * 2.2 / (tf{i} + 1.2 * (0.25 + 0.75 * dl / avgdl))"
        for i in range(len(terms))
    )
    every, score = " AND ".join(f"tf{i} > 0" for i in range(len(terms))), f"round(-({part}), 6)" if rounded else f"-({part})"
    return f"""WITH s AS ({_SECTIONS}), tok AS (SELECT *, {_TOKENS.format('catchline')} AS tc, {_TOKENS.format('content')} AS tb FROM s),
    c AS (SELECT {keep}, (len(tc) + len(tb))::DOUBLE AS dl, {columns} FROM tok),
    st AS (SELECT count(*)::DOUBLE AS n, avg(dl) AS avgdl, {df} FROM c),
    r AS (SELECT {keep}, {score} AS score FROM c, st WHERE {every}) {tail}"""


@query(_bm25_sql(["with", "from"], "SELECT doc_id, lang, source, score FROM r ORDER BY score, doc_id LIMIT 21"))
def bm25_search(t, spark):
    """All-words search ranked by BM25 (catchline 5, content 1), first page plus one row."""
    found = search.bm25(_sections(t), {"catchline": 5.0, "content": 1.0}, "with from").withColumn("score", F.round("score", 6))
    return search.page(found.select("doc_id", "lang", "source", "score"), ["score", "doc_id"], 20)


@query(_bm25_sql(["the", "license"], "SELECT doc_id, lang, source, score FROM r WHERE lang = 'en' ORDER BY score, doc_id LIMIT 21 OFFSET 5"))
def bm25_search_faceted(t, spark):
    """A very common word (floored weight) with a rare one, a facet filter, and an offset."""
    found = search.bm25(_sections(t), {"catchline": 5.0, "content": 1.0}, "the license").withColumn("score", F.round("score", 6))
    return search.page(found.filter("lang = 'en'").select("doc_id", "lang", "source", "score"), ["score", "doc_id"], 20, 5)


@query("""WITH w AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text || ' ' || source), '[a-z0-9]+')) AS words FROM documents)
SELECT doc_id FROM w WHERE list_contains(words, 'with') AND list_contains(words, 'from')""")
def and_search_union(t, spark):
    """Exact ASCII words over the union of a document's fields."""
    return search.and_search(t("documents"), "doc_id", ["text", "source"], "With FROM")


@query("""WITH w AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM documents)
SELECT word, substr(word, 1, 2) AS shard, count(*) AS df, min(doc_id) AS first_id, max(doc_id) AS last_id FROM w GROUP BY word""")
def inverted_index_stats(t, spark):
    """A4 K6: the inverted index's words with shard, document frequency and the ends of their lists."""
    index = search.inverted_index(t("documents"), "doc_id", ["text"], block=128)
    return index.groupBy("word", "shard").agg(F.sum("n").alias("df"), F.min(F.col("ids")[0]).alias("first_id"), F.max(F.element_at("ids", -1)).alias("last_id"))


@query("""WITH l AS (SELECT doc_id, row_number() OVER (ORDER BY n_chars, doc_id) AS r1 FROM documents WHERE contains(lower(text), 'license')),
c AS (SELECT doc_id, row_number() OVER (ORDER BY quality DESC, doc_id) AS r2 FROM labels WHERE toxic = 1)
SELECT coalesce(l.doc_id, c.doc_id) AS doc_id, round(coalesce(1.0 / (60 + r1), 0) + coalesce(0.8 / (60 + r2), 0), 9) AS score FROM l FULL JOIN c ON l.doc_id = c.doc_id""")
def rrf_fusion(t, spark):
    """Reciprocal-rank fusion of a lexical and a concept list."""
    lexical = search.positions(t("documents").filter(F.contains(F.lower("text"), F.lit("license"))), ["n_chars", "doc_id"])
    concept = search.positions(t("labels").filter("toxic = 1"), [F.col("quality").desc(), "doc_id"])
    return search.rank_fusion(lexical, concept, "doc_id").select("doc_id", F.round("score", 9).alias("score"))


@query("""WITH f AS (SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS r FROM documents WHERE contains(lower(text), 'with'))
SELECT d.doc_id, round(CASE WHEN d.doc_id = 42 THEN 10.0 ELSE 1.0 / (60 + r) END, 9) AS score FROM documents d LEFT JOIN f ON d.doc_id = f.doc_id WHERE d.doc_id = 42 OR r IS NOT NULL""")
def exact_lookup_first(t, spark):
    """An exact id scores 10, whether or not a list holds it."""
    listed = search.positions(t("documents").filter(F.contains(F.lower("text"), F.lit("with"))), [F.col("n_chars").desc(), "doc_id"]).select("doc_id", "position")
    joined = t("documents").select("doc_id").join(listed, "doc_id", "left").filter((F.col("doc_id") == 42) | F.col("position").isNotNull())
    score = F.when(F.col("doc_id") == 42, F.lit(10.0)).otherwise(1.0 / (60 + F.col("position")))
    return joined.select("doc_id", F.round(score, 9).alias("score"))


_LIKES = search.expansion_terms("the license of a widget")


@query(f"""SELECT source, lang, count(*) AS n_docs, min(doc_id) AS first_doc FROM documents WHERE {' OR '.join(f"lower(text) LIKE '%{w}%'" for w in _LIKES)} GROUP BY source, lang""")
def query_expansion_like(t, spark):
    """Texts LIKE the query or any of its words, by where they come from."""
    hits = t("documents").filter(search.like_any(F.col("text"), _LIKES))
    return hits.groupBy("source", "lang").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"))


@query("""SELECT item_id, (CASE WHEN contains(lower(text), 'ered') THEN 1 ELSE 0 END + CASE WHEN contains(lower(text), 'the') THEN 1 ELSE 0 END + CASE WHEN contains(lower(text), 'the ered') THEN 4 ELSE 0 END)::INTEGER AS concept_score FROM benchmark""")
def concept_scores(t, spark):
    """Words contained, and 4 more for the whole query."""
    return t("benchmark").select("item_id", search.concept_score(F.array("text"), "the ered").cast("int").alias("concept_score"))


@query("""SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) - 1 AS version_ordinal FROM conversations""")
def version_ordinals(t, spark):
    """Ordinals of printed versions in print order."""
    return relational.ordinals(t("conversations"), ["conv_id", "role"], ["turn"], "version_ordinal").select("conv_id", "turn", "role", "version_ordinal")


@query("""SELECT conv_id, role, turn, length(text) AS n_chars FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) = 1""")
def first_version_only(t, spark):
    """The first printed version of each."""
    return relational.first_per(t("conversations"), ["conv_id", "role"], ["turn"]).select("conv_id", "role", "turn", F.length("text").cast("long").alias("n_chars"))


@query("""SELECT conv_id, role, text_key, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS note_ordinal FROM
(SELECT conv_id, role, sha256(text) AS text_key, min(turn) AS turn FROM conversations GROUP BY ALL)""")
def note_ordinals(t, spark):
    """Notes made distinct per document, then numbered in order."""
    distinct = t("conversations").groupBy("conv_id", "role", F.sha2("text", 256).alias("text_key")).agg(F.min("turn").alias("turn"))
    return relational.ordinals(distinct, ["conv_id"], ["turn"], "note_ordinal", 1)


@query("""SELECT event_id, user_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS owner_id FROM events""")
def asof_owner(t, spark):
    """Each row's nearest preceding anchor."""
    owned = relational.asof_backward(t("events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "signup", "event_id", "owner_id")
    return owned.select("event_id", "user_id", "owner_id")


@query("""SELECT event_id, user_id, first_value(CASE WHEN event_type IN ('signup', 'error') THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS closed_by FROM events""")
def span_until_next(t, spark):
    """Each row's span ends at the next anchor or heading."""
    closed = relational.span_end(t("events"), ["user_id"], ["ts", "event_id"], F.col("event_type").isin("signup", "error"), "event_id", "closed_by")
    return closed.select("event_id", "user_id", "closed_by")


_RANGES = [(1, 1, 10, "small"), (2, 8, 25, "middle"), (3, 26, 45, "large")]


@query(f"""WITH r(ord, lo, hi, title) AS (VALUES {', '.join(map(str, _RANGES))})
SELECT p_partkey, p_size, arg_min(title, ord) AS title FROM part LEFT JOIN r ON p_size BETWEEN lo AND hi GROUP BY p_partkey, p_size""")
def range_title_lookup(t, spark):
    """The first range of a roster that covers a number; uncovered ones stay null."""
    ranges = spark.createDataFrame(_RANGES, "ord int, lo int, hi int, title string")
    return relational.range_lookup(t("part").select("p_partkey", "p_size"), "p_size", ranges, "lo", "hi", "ord", ["title"])


@query("""WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) % 2 ORDER BY o_orderdate, o_orderkey) AS rn FROM orders),
b AS (SELECT * FROM o WHERE rn = 1 AND year(o_orderdate) % 2 = 0), a AS (SELECT * FROM o WHERE rn = 1 AND year(o_orderdate) % 2 = 1)
SELECT coalesce(b.o_custkey, a.o_custkey) AS o_custkey,
CASE WHEN b.o_custkey IS NULL THEN 'added' WHEN a.o_custkey IS NULL THEN 'removed' WHEN b.o_orderstatus IS DISTINCT FROM a.o_orderstatus OR b.o_orderpriority IS DISTINCT FROM a.o_orderpriority THEN 'changed' ELSE 'unchanged' END AS status,
CASE WHEN b.o_custkey IS NULL OR a.o_custkey IS NULL THEN '' ELSE concat_ws(',', CASE WHEN b.o_orderstatus IS DISTINCT FROM a.o_orderstatus THEN 'o_orderstatus' END, CASE WHEN b.o_orderpriority IS DISTINCT FROM a.o_orderpriority THEN 'o_orderpriority' END) END AS changed_fields
FROM b FULL JOIN a ON b.o_custkey = a.o_custkey""")
def edition_diff(t, spark):
    """Two editions of one table compared by key and field, nulls being equal."""
    parity = F.year("o_orderdate") % 2
    first = relational.first_per(t("orders").withColumn("p", parity), ["o_custkey", "p"], ["o_orderdate", "o_orderkey"])
    return relational.edition_diff(first.filter("p = 0"), first.filter("p = 1"), "o_custkey", ["o_orderstatus", "o_orderpriority"])


@query("""WITH d AS (SELECT n_nationkey, max(CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END) AS b, max(CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment END) AS a FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL)
SELECT count(*) FILTER (WHERE b IS NULL AND a IS NOT NULL) AS added, count(*) FILTER (WHERE b IS NOT NULL AND a IS NULL) AS removed, count(*) FILTER (WHERE b IS NOT NULL AND a IS NOT NULL AND a <> b) AS changed, count(*) FILTER (WHERE a = b) AS unchanged FROM d""")
def diff_counts(t, spark):
    """Counts of a diff's states."""
    c = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    side = lambda p: c.filter(F.col("c_custkey") % 2 == p).groupBy("n_nationkey").agg(F.max("c_mktsegment").alias("segment"))
    return relational.diff_conserves(relational.edition_diff(side(0), side(1), "n_nationkey", ["segment"]))


@query("""SELECT o_orderkey, CASE WHEN count(l_orderkey) = 0 THEN 'missing-result' WHEN bool_or(l_returnflag = 'R') THEN 'result-error' WHEN bool_and(l_linestatus = 'F') THEN 'matched' ELSE 'pending' END AS status
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def reconcile_status(t, spark):
    """Parents with the state that their children give them."""
    lines = t("lineitem").groupBy("l_orderkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("bad"), F.bool_and(F.col("l_linestatus") == "F").alias("done"))
    joined = t("orders").select("o_orderkey").join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    status = F.when(F.col("l_orderkey").isNull(), "missing-result").when(F.col("bad"), "result-error").when(F.col("done"), "matched").otherwise("pending")
    return joined.select("o_orderkey", status.alias("status"))


@query("""SELECT c_custkey, count(o_orderkey) AS n_children, CASE WHEN bool_and(o_orderstatus = 'F') THEN 'resolved' ELSE 'unresolved' END AS status FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""")
def all_match_rollup(t, spark):
    """Resolved only if there are children and every one matches."""
    children = t("orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderstatus")
    return relational.all_matched(t("customer").select("c_custkey"), "c_custkey", children, F.col("o_orderstatus") == "F")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, p_name AS resolved_name FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size <= 25) ON p_partkey = l_partkey""")
def unresolved_refs_kept(t, spark):
    """References resolved where the target exists, kept with null where not."""
    known = t("part").filter("p_size <= 25").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("resolved_name"))
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey").join(known, "l_partkey", "left")


@query("""SELECT 'order-customer' AS rule, o_orderkey::VARCHAR AS row_key FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
UNION ALL SELECT 'line-quantity', l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR FROM lineitem WHERE l_quantity > 49
UNION ALL SELECT 'segment-enum', c_custkey::VARCHAR FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY', 'HOUSEHOLD')
UNION ALL SELECT 'duplicate-name', n_name FROM nation GROUP BY n_name HAVING count(*) > 1""")
def integrity_violations(t, spark):
    """Foreign keys, plausibility, enums and uniqueness as one table of violations."""
    rich = t("customer").filter("c_acctbal > 0")
    return relational.violations([
        ("order-customer", relational.missing_parent(t("orders"), "o_custkey", rich, "c_custkey"), F.col("o_orderkey")),
        ("line-quantity", t("lineitem").filter("l_quantity > 49"), F.concat_ws("-", "l_orderkey", "l_linenumber")),
        ("segment-enum", t("customer").filter(~F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD")), F.col("c_custkey")),
        ("duplicate-name", relational.duplicates(t("nation"), ["n_name"]), F.col("n_name")),
    ])


_PR = """WITH p AS (SELECT d.lang, l.quality = 1 AS e, d.n_chars >= 1000 AS a FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
s AS (SELECT lang, count(*) FILTER (WHERE e AND a) AS tp, count(*) FILTER (WHERE NOT e AND a) AS fp, count(*) FILTER (WHERE e AND NOT a) AS fn FROM p WHERE e OR a GROUP BY lang)"""


def _confusion(t):
    labelled = t("labels").join(t("documents").select("doc_id", "lang", "n_chars"), "doc_id")
    return quality.confusion(labelled.filter("quality = 1"), labelled.filter("n_chars >= 1000"), ["doc_id"], ["lang"])


@query(_PR + """ SELECT lang, tp, fp, fn, round(CASE WHEN tp + fp = 0 THEN 1.0 ELSE tp::DOUBLE / (tp + fp) END, 9) AS precision, round(CASE WHEN tp + fn = 0 THEN 1.0 ELSE tp::DOUBLE / (tp + fn) END, 9) AS recall FROM s""")
def precision_recall(t, spark):
    """Counts and ratios per group."""
    return quality.micro(_confusion(t), ["lang"]).withColumn("precision", F.round("precision", 9)).withColumn("recall", F.round("recall", 9))


@query(_PR + """, m AS (SELECT sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn FROM s)
SELECT tp, fp, fn, round(tp::DOUBLE / (tp + fp), 9) AS precision, round(tp::DOUBLE / (tp + fn), 9) AS recall, tp::DOUBLE / (tp + fp) >= 0.8 AND tp::DOUBLE / (tp + fn) >= 0.5 AS passed FROM m""")
def gate_report(t, spark):
    """Ratios of summed counts against thresholds."""
    gated = quality.gate(quality.micro(_confusion(t)), {"precision": 0.8, "recall": 0.5})
    return gated.withColumn("precision", F.round("precision", 9)).withColumn("recall", F.round("recall", 9))


@query("""SELECT round(avg(CASE WHEN (l_returnflag = 'N') IS NOT DISTINCT FROM (l_linestatus = 'O') THEN 1.0 ELSE 0.0 END), 9) AS exact_rate FROM lineitem""")
def exact_match_rate(t, spark):
    """A10 Q14: share of rows that agree, nulls agreeing with nulls."""
    equal = (F.col("l_returnflag") == "N").eqNullSafe(F.col("l_linestatus") == "O")
    return quality.exact_rate(t("lineitem"), equal, "exact_rate").withColumn("exact_rate", F.round("exact_rate", 9))


_TARGETS = [("click", 5000), ("purchase", 100), ("view", 2000), ("refund", 10)]


@query(f"""WITH g(event_type, target) AS (VALUES {', '.join(map(str, _TARGETS))})
SELECT g.event_type, target::BIGINT AS target, count(event_id) AS n, greatest(0, target - count(event_id))::BIGINT AS remaining FROM g LEFT JOIN events e ON e.event_type = g.event_type GROUP BY g.event_type, target""")
def coverage_targets(t, spark):
    """Counts against targets and what remains."""
    return quality.coverage(t("events"), "event_type", spark.createDataFrame(_TARGETS, "event_type string, target long"))


@query("""WITH g AS (SELECT unnest(generate_series(1, (SELECT max(user_id) + 50 FROM events))) AS k), r AS (SELECT g.k, count(event_id) AS n, coalesce(bool_or(event_type = 'error'), false) AS bad FROM g LEFT JOIN events ON user_id = g.k GROUP BY g.k)
SELECT count(*) AS expected, count(*) FILTER (WHERE n > 0) AS acquired, count(*) FILTER (WHERE n = 0) AS missing, count(*) FILTER (WHERE bad) AS review, min(CASE WHEN n = 0 THEN k END) AS first_missing, max(CASE WHEN n = 0 THEN k END) AS last_missing FROM r""")
def session_rollup(t, spark):
    """The range of expected numbers against what is there, with what needs review."""
    have = t("events").groupBy(F.col("user_id").alias("k")).agg(F.count("*").alias("n"), F.bool_or(F.col("event_type") == "error").alias("bad"))
    expected = spark.range(1, t("events").agg(F.max("user_id")).first()[0] + 51).withColumnRenamed("id", "k")
    joined, absent = expected.join(have, "k", "left"), F.col("n").isNull()
    return joined.agg(
        F.count("*").alias("expected"), F.count_if(~absent).alias("acquired"), F.count_if(absent).alias("missing"), F.count_if(F.coalesce("bad", F.lit(False))).alias("review"),
        F.min(F.when(absent, F.col("k"))).alias("first_missing"), F.max(F.when(absent, F.col("k"))).alias("last_missing"),
    )


@query("""WITH c AS (SELECT l_orderkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags, string_agg(DISTINCT l_linestatus, ',' ORDER BY l_linestatus) AS states FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, flags, states, CASE WHEN contains(flags, 'R') AND contains(flags, 'A') THEN 'mixed' WHEN contains(flags, 'R') THEN 'returned' ELSE 'plain' END AS tag FROM c WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def candidate_groups(t, spark):
    """Sorted sets per group, classified, without the groups already known."""
    grouped = t("lineitem").groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",").alias("flags"), F.array_join(F.array_sort(F.collect_set("l_linestatus")), ",").alias("states"))
    known = t("orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    r, a = F.contains("flags", F.lit("R")), F.contains("flags", F.lit("A"))
    return grouped.join(known, "l_orderkey", "left_anti").withColumn("tag", F.when(r & a, "mixed").when(r, "returned").otherwise("plain"))


@query("""SELECT o_orderpriority, arg_min(o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || lpad(o_orderkey::VARCHAR, 12, '0')) AS first_order, arg_max(o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || lpad(o_orderkey::VARCHAR, 12, '0')) AS last_order FROM orders GROUP BY ALL""")
def volume_minmax(t, spark):
    """The first and last of each group by a sort key."""
    key = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"))
    return t("orders").groupBy("o_orderpriority").agg(F.min_by("o_orderkey", key).alias("first_order"), F.max_by("o_orderkey", key).alias("last_order"))


@query("""WITH x AS (SELECT lower(unnest(regexp_extract_all(html, '<\\s*([A-Za-z][A-Za-z0-9]*)', 1))) AS tag FROM pages) SELECT tag, count(*) AS n FROM x GROUP BY tag ORDER BY n DESC, tag LIMIT 25""")
def top_histogram(t, spark):
    """The most frequent tags, ties by name."""
    return markup.tag_counts(t("pages")).orderBy(F.col("n").desc(), "tag").limit(25)


_BOLD = [(1, "<p><b>161.005 Short  title.</b> Text <B class='x'>ORS <i>2</i></B></p>"), (2, "no bold"), (3, "<b>open only")]


@query("""WITH v(id, html) AS (VALUES """ + ", ".join(f"({i}, $${h}$$)" for i, h in _BOLD) + """), b AS (SELECT id, unnest(regexp_extract_all(html, '(?is)<b\\b[^>]*>(.*?)</b\\s*>', 1)) AS raw FROM v)
SELECT id, trim(regexp_replace(regexp_replace(raw, '<[^>]+>', '', 'g'), '\\s+', ' ', 'g')) AS bold FROM b""")
def bold_runs(t, spark):
    """Texts of bold runs."""
    return spark.createDataFrame(_BOLD, "id int, html string").select("id", F.explode(markup.bold_texts(F.col("html"))).alias("bold"))


@query("""SELECT page_id, CASE WHEN regexp_matches(html, '(?is)<title[^>]*>(.*?)</title\\s*>') THEN trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title\\s*>', 1), '\\s+', ' ', 'g')) END AS title,
nullif(lower(regexp_extract(substr(html, 1, 8192), '(?i)charset\\s*=\\s*["'']?([A-Za-z0-9_.:-]+)', 1)), '') AS charset FROM pages""")
def page_titles(t, spark):
    """Title and declared charset."""
    return t("pages").select("page_id", markup.page_title(F.col("html")).alias("title"), markup.declared_charset(F.col("html")).alias("charset"))


@query("""WITH x AS (SELECT unnest(regexp_extract_all(html, '(?i)href\\s*=\\s*["'']([^"'']+)["'']', 1)) AS raw FROM pages)
SELECT DISTINCT replace(replace(replace(replace(replace(replace(raw, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', chr(160)), '&amp;', '&') AS href FROM x""")
def page_links(t, spark):
    """Distinct link targets."""
    return markup.links(t("pages"))


@query("""SELECT page_id, CASE WHEN length(trim(html)) = 0 THEN 'empty' WHEN len(regexp_extract_all(html, '(?i)<p\\b')) = 0 THEN 'no-paragraphs' WHEN len(regexp_extract_all(html, '(?i)<b\\b')) = 0 THEN 'no-bold-runs'
WHEN len(regexp_extract_all(html, '(?i)</b\\s*>')) < len(regexp_extract_all(html, '(?i)<b\\b')) THEN 'unclosed-bold' END AS defect FROM pages""")
def structural_defects(t, spark):
    """The first defect of each page."""
    return t("pages").select("page_id", markup.structural_defect(F.col("html")).alias("defect"))


@query("""SELECT count(*) AS n_pages, sum(len(regexp_extract_all(html, '(?i)<b\\b')))::BIGINT AS n_bold_open, sum(len(regexp_extract_all(html, '(?i)</b\\s*>')))::BIGINT AS n_bold_close, sum(len(regexp_extract_all(html, '(?i)<p\\b')))::BIGINT AS n_paragraphs,
sum(len(regexp_extract_all(html, '(?i)<script\\b')))::BIGINT AS n_scripts, sum(len(regexp_extract_all(html, '(?i)href\\s*=')))::BIGINT AS n_links FROM pages""")
def structure_probe(t, spark):
    """Structure counts over all pages."""
    return t("pages").agg(F.count("*").alias("n_pages"), *[F.sum(c).cast("long").alias(n) for n, c in markup.structure(F.col("html")).items()])


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
s AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INTEGER AS s FROM l)
SELECT doc_id, s AS start_at, (s + length(line))::INTEGER AS end_at, md5(line) AS line_md5 FROM s WHERE trim(line) <> ''""")
def line_spans(t, spark):
    """Lines that aren't blank, with their offsets."""
    spans = t("documents").select("doc_id", F.explode(text.line_spans(F.col("text"))).alias("s"))
    return spans.select("doc_id", F.col("s.start").alias("start_at"), F.col("s.end").alias("end_at"), F.md5(F.col("s.line").cast("binary")).alias("line_md5"))


@query("""SELECT doc_id, unnest(regexp_extract_all(text, '\\d{1,3}[A-Z]?\\.\\d{3,4}')) AS section_number FROM documents""")
def section_refs(t, spark):
    """Section numbers a text names, in order, repeats included."""
    return t("documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(markup.SECTION), F.lit(0))).alias("section_number"))


@query("""SELECT doc_id, substr(text, 1, 400) AS excerpt, length(text) > 500 AS text_truncated, CASE WHEN length(text) > 500 THEN substr(text, 1, 500) ELSE text END AS shown FROM documents""")
def text_truncation(t, spark):
    """Excerpts in characters and whether something is left out."""
    c = F.col("text")
    return t("documents").select("doc_id", text.excerpt(c, 400).alias("excerpt"), text.is_truncated(c, 500).alias("text_truncated"), text.excerpt(c, 500).alias("shown"))


_ALL = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in _ALL))
def dataset_info(t, spark):
    """K9 A1: row counts of all tables."""
    return files.row_counts({name: t(name) for name in _ALL})


@query("SELECT DISTINCT year(o_orderdate)::INTEGER AS session_year FROM orders")
def distinct_years(t, spark):
    """A2: distinct years."""
    return t("orders").select(F.year("o_orderdate").alias("session_year")).distinct()


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
def status_histogram(t, spark):
    """A3 A5: counts by disposition."""
    return t("orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query("SELECT doc_id, sha256('ors:' || lang || ':' || doc_id::VARCHAR || ':' || coalesce(source, 'None')) AS stable_id, sha256(text) AS text_sha256 FROM documents")
def stable_ids(t, spark):
    """Content and identity digests."""
    return t("documents").select("doc_id", keys.stable_id(F.lit("ors"), F.col("lang"), F.col("doc_id"), F.col("source")).alias("stable_id"), F.sha2("text", 256).alias("text_sha256"))


@query("SELECT event_id, user_id, (props->>'$.k')::INTEGER AS k FROM events WHERE (props->>'$.k')::INTEGER >= 50")
def json_props_filter(t, spark):
    """Fields of JSON payloads, typed and filtered."""
    k = F.get_json_object("props", "$.k").cast("int")
    return t("events").select("event_id", "user_id", k.alias("k")).filter("k >= 50")


@query("""WITH h AS (SELECT user_id, event_id, value, first_value(event_id) OVER w AS root, row_number() OVER w AS n FROM events WHERE event_type IN ('purchase', 'signup') AND ts <= (SELECT max(ts) - INTERVAL 1 DAY FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT user_id, root, max(n) AS n_applied, arg_max(event_id, n) AS head FROM h GROUP BY user_id, root""")
def history_asof(t, spark):
    """Each linear history as of a date: its root, how many steps it took and where it stands."""
    events = t("events")
    cut = events.agg((F.max("ts") - F.expr("INTERVAL 1 DAY")).alias("cut"))
    steps = events.filter(F.col("event_type").isin("purchase", "signup")).join(F.broadcast(cut), F.col("ts") <= F.col("cut"))  # one row
    chain = relational.linear_history(steps, ["user_id"], ["ts", "event_id"], "event_id")
    return chain.groupBy("user_id", "root").agg(F.max("depth").alias("n_applied"), F.max_by("event_id", "depth").alias("head"))


@query("""WITH RECURSIVE e AS (SELECT n_nationkey AS node, CASE WHEN n_nationkey >= 5 THEN n_nationkey - 5 END AS parent FROM nation),
chain(node, root, depth) AS (SELECT node, node, 0 FROM e WHERE parent IS NULL UNION ALL SELECT e.node, c.root, c.depth + 1 FROM e JOIN chain c ON e.parent = c.node)
SELECT node, root, depth FROM chain""")
def predecessor_chains(t, spark):
    """Predecessor edges followed to their roots by a recursive query."""
    edges = t("nation").select(F.col("n_nationkey").alias("node"), F.when(F.col("n_nationkey") >= 5, F.col("n_nationkey") - 5).alias("parent"))
    return relational.chain_depths(edges, "node", "parent", spark)


@query("""SELECT p_partkey, lpad(regexp_extract(k, '^(\\d+)', 1), 6, '0') || CASE WHEN regexp_extract(k, '([A-Z]?)$', 1) = '' THEN ' ' ELSE regexp_extract(k, '([A-Z]?)$', 1) END AS sort_key
FROM (SELECT p_partkey, p_size::VARCHAR || CASE p_partkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN '' ELSE 'B' END AS k FROM part)""")
def chapter_keys(t, spark):
    """Sort keys of chapter numbers with letters."""
    letter = F.when(F.col("p_partkey") % 3 == 0, "a").when(F.col("p_partkey") % 3 == 1, "").otherwise("b")
    return t("part").select("p_partkey", keys.chapter_sort_key(F.concat(F.col("p_size").cast("string"), letter)).alias("sort_key"))


@query("""SELECT e.action, e.section, e.e AND NOT e.a AS missing FROM (SELECT l_returnflag AS action, (l_shipdate::DATE)::VARCHAR AS section, bool_or(l_linestatus = 'O') AS e, bool_or(l_linestatus = 'F') AS a FROM lineitem GROUP BY ALL) e WHERE e.e <> e.a""")
def set_differences(t, spark):
    """Pairs that only one of two sets has."""
    pairs = lambda s: t("lineitem").filter(F.col("l_linestatus") == s).select(F.col("l_returnflag").alias("action"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("section")).distinct()
    e, a = pairs("O"), pairs("F")
    keys_ = ["action", "section"]
    return e.join(a, keys_, "left_anti").withColumn("missing", F.lit(True)).unionByName(a.join(e, keys_, "left_anti").withColumn("missing", F.lit(False)))


@query("""WITH s AS (SELECT unnest(string_split(text, '. ')) AS s, doc_id FROM documents) SELECT doc_id, count(*) FILTER (WHERE trim(s) <> '') AS n_sentences FROM s GROUP BY doc_id""")
def sentence_counts(t, spark):
    """Sentences of each text."""
    return t("documents").select("doc_id", F.size(text.sentences(F.col("text"))).cast("long").alias("n_sentences"))
