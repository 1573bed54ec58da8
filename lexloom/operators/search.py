"""Search: BM25 over weighted fields, exact-word search, inverted indexes, rank fusion, query expansion.

Over a corpus without an index a query's few terms are counted in place (no postings shuffle); corpus figures are one
aggregate row. A corpus that is asked often gets a written index: postings in the order of their words, so that a
query reads the row groups of its own words only, however common a word is.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.functions.text import ascii_tokens, search_tokens
from lexloom.operators.relational import without_lineage

K1, B, RRF_K = 1.2, 0.75, 60
MAX_PAGE, MAX_OFFSET = 100, 100_000
#: Words that expand no query (fixed values).
STOP_WORDS = ("a", "an", "the", "is", "are", "of", "to", "for", "my", "how", "do", "i", "in", "on", "what", "does", "can", "and", "or", "about", "me")


def query_terms(query: str) -> list[str]:
    """Distinct folded words of a query, in order."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", query.lower()) if not unicodedata.combining(c))
    return list(dict.fromkeys(re.findall(r"[^\W_]+", plain)))


def _equals(term: str):
    return lambda token: token == term


def _marked(field: int):
    return lambda token: F.struct(token.alias("word"), F.lit(field).alias("field"))


def _score(n_terms: int) -> Column:
    """BM25 of a row with _n, _avgdl, _length and, per term, _df and _tf; lower is better."""
    total = F.lit(0.0)
    for i in range(n_terms):
        idf = F.ln((F.col("_n") - F.col(f"_df{i}") + 0.5) / (F.col(f"_df{i}") + 0.5))
        idf = F.when(idf <= 0, F.lit(1e-6)).otherwise(idf)
        tf = F.col(f"_tf{i}")
        total = total + idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("_length") / F.col("_avgdl")))
    return -total


def _every(n_terms: int) -> Column:
    every = F.lit(n_terms > 0)
    for i in range(n_terms):
        every = every & (F.col(f"_tf{i}") > 0)
    return every


def bm25(docs: DataFrame, fields: dict[str, float], query: str) -> DataFrame:
    """The rows that hold every word of the query, with score: BM25, lower is better.

    Term frequencies are summed over the fields with their weights; lengths are unweighted; an inverse document
    frequency of zero or less counts as 1e-6. A query without words finds nothing.
    """
    terms = query_terms(query)
    tokens = {f: search_tokens(F.coalesce(F.col(f), F.lit(""))) for f in fields}
    staged = docs.select("*", *[t.alias(f"_tokens_{f}") for f, t in tokens.items()])
    counted = staged.withColumn("_length", sum(F.size(f"_tokens_{f}") for f in fields))
    for i, term in enumerate(terms):
        tf = sum(F.lit(float(w)) * F.size(F.filter(f"_tokens_{f}", _equals(term))) for f, w in fields.items())
        counted = counted.withColumn(f"_tf{i}", tf)
    counted = counted.drop(*[f"_tokens_{f}" for f in fields])
    stats = counted.agg(F.count("*").alias("_n"), F.avg("_length").alias("_avgdl"), *[F.count_if(F.col(f"_tf{i}") > 0).alias(f"_df{i}") for i in range(len(terms))])
    scored = counted.filter(_every(len(terms))).crossJoin(F.broadcast(stats))  # one row
    return scored.withColumn("score", _score(len(terms))).select(*docs.columns, "score")


def write_ranked_index(docs: DataFrame, key: str, fields: list[str], path: str) -> None:
    """The index that ranked() reads: postings by word, with a frequency per field, and the corpus' figures (R2, A4).

    A posting is a row, so no list of a word's documents is ever gathered; ranges of (word, key) split common words.
    """
    staged = docs.select(F.col(key).alias("key"), *[search_tokens(F.coalesce(F.col(f), F.lit(""))).alias(f"t{i}") for i, f in enumerate(fields)])
    staged = staged.withColumn("length", sum(F.size(f"t{i}") for i in range(len(fields))))
    marked = F.concat(*[F.transform(f"t{i}", _marked(i)) for i in range(len(fields))])
    words = staged.select("key", "length", F.explode(marked).alias("w")).select("key", "length", "w.word", "w.field")
    rows = words.groupBy("word", "key", "length").agg(*[F.count_if(F.col("field") == i).alias(f) for i, f in enumerate(fields)])
    rows.repartitionByRange("word", "key").sortWithinPartitions("word", "key").write.mode("errorifexists").parquet(f"{path}/postings")
    staged.agg(F.count("*").alias("_n"), F.avg("length").alias("_avgdl")).write.mode("errorifexists").parquet(f"{path}/corpus")


def ranked(spark: SparkSession, path: str, fields: dict[str, float], query: str) -> DataFrame:
    """(key, score) as bm25() gives, from an index of write_ranked_index(); only the words' postings are read.

    Keys must be unique.
    """
    terms = query_terms(query)
    hits = spark.read.parquet(f"{path}/postings").filter(F.col("word").isin(terms))
    tf = sum(F.lit(float(w)) * F.col(f) for f, w in fields.items())
    held = hits.groupBy("key", F.col("length").alias("_length")).agg(*[F.sum(F.when(F.col("word") == w, tf).otherwise(0.0)).alias(f"_tf{i}") for i, w in enumerate(terms)], F.lit(True).alias("_held"))
    found = hits.agg(*[F.count_if((F.col("word") == w) & (tf > 0)).alias(f"_df{i}") for i, w in enumerate(terms)], F.lit(True).alias("_one"))
    stats = spark.read.parquet(f"{path}/corpus").crossJoin(F.broadcast(found))  # one row each
    return held.filter(_every(len(terms))).crossJoin(F.broadcast(stats)).select("key", _score(len(terms)).alias("score"))


def check_page(limit: int, offset: int) -> None:
    """Fails for a page outside the bounds."""
    if not 1 <= limit <= MAX_PAGE or not 0 <= offset <= MAX_OFFSET:
        raise ValueError(f"limit must be 1 to {MAX_PAGE} and offset 0 to {MAX_OFFSET}")


def page(df: DataFrame, order: list[Column | str], limit: int, offset: int = 0) -> DataFrame:
    """limit + 1 rows from offset in order; the extra row tells that there is a next page."""
    check_page(limit, offset)
    return df.orderBy(*order).offset(offset).limit(limit + 1)


def envelope(rows: DataFrame, limit: int, offset: int = 0) -> DataFrame:
    """A page() as one row: items (limit at most, in order), limit, offset, next_offset or null."""
    # one partition after a limit, so the numbers follow the order
    numbered = rows.withColumn("_at", F.monotonically_increasing_id())
    items = numbered.agg(F.array_sort(F.collect_list(F.struct("_at", F.struct(*rows.columns).alias("item")))).alias("found"))
    more = F.when(F.size("found") > limit, F.lit(offset + limit))
    return items.select(F.slice(F.transform("found", lambda x: x["item"]), 1, limit).alias("items"), F.lit(limit).alias("limit"), F.lit(offset).alias("offset"), more.alias("next_offset"))


def and_search(docs: DataFrame, doc_id: str, fields: list[str], query: str) -> DataFrame:
    """Ids of the rows whose fields together hold every ASCII word of the query."""
    words = list(dict.fromkeys(re.findall(r"[a-z0-9]+", query.lower())))
    have = ascii_tokens(F.concat_ws(" ", *fields))
    hit = F.size(F.array_intersect(have, F.array(*[F.lit(w) for w in words]))) == len(words) if words else F.lit(False)
    return docs.filter(hit).select(doc_id)


def and_search_index(index: DataFrame, query: str) -> DataFrame:
    """(id) of the documents that hold every ASCII word of the query, from an inverted_index().

    Blocks are met one by one: the words' lists of a block are intersected, and a block that lacks a word is left out.
    """
    words = list(dict.fromkeys(re.findall(r"[a-z0-9]+", query.lower())))
    lists = index.filter(F.col("word").isin(words)).groupBy("block").agg(F.collect_list("ids").alias("lists"))
    common = F.aggregate("lists", F.col("lists")[0], F.array_intersect)
    return lists.filter(F.size("lists") == len(words)).select(F.explode(common).alias("id"))


def inverted_index(docs: DataFrame, doc_id: str, fields: list[str], block: int = 65_536) -> DataFrame:
    """word, shard, block, n, ids (ascending) (A4): a word's list in parts, one for each block of documents.

    Documents fall into blocks by a hash of their ids, ``block`` to each on average, so no list grows with the corpus.
    """
    blocks = max(1, -(-docs.count() // block))
    rows = postings(docs, doc_id, fields).withColumn("block", F.pmod(F.xxhash64(doc_id), F.lit(blocks)))
    return rows.groupBy("word", "block").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(doc_id)).alias("ids")).withColumn("shard", F.substring("word", 1, 2))


def postings(docs: DataFrame, doc_id: str, fields: list[str]) -> DataFrame:
    """(word, doc_id) rows, one per distinct word of a document."""
    return docs.select(doc_id, F.explode(F.array_distinct(ascii_tokens(F.concat_ws(" ", *fields)))).alias("word"))


def rank_fusion(lexical: DataFrame, concept: DataFrame, doc_id: str, weight: float = 0.8, k: int = RRF_K) -> DataFrame:
    """Two lists with a position each -> doc_id and score 1/(k+r) + weight/(k+r'), absent ranks adding nothing."""
    both = lexical.select(doc_id, F.col("position").alias("r1")).join(concept.select(doc_id, F.col("position").alias("r2")), doc_id, "full_outer")
    score = F.coalesce(1.0 / (k + F.col("r1")), F.lit(0.0)) + F.coalesce(F.lit(weight) / (k + F.col("r2")), F.lit(0.0))
    return both.withColumn("score", score)


def positions(df: DataFrame, order: list[Column | str]) -> DataFrame:
    """A list with its 1-based positions. Rows are dealt by ranges of the order; a range counts on from those before it."""
    dealt = without_lineage(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = dealt.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    numbered = dealt.withColumn("_at", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    return numbered.join(F.broadcast(starts), "_part").select(*df.columns, (F.col("_start") + F.col("_at")).alias("position"))


def concept_score(terms: Column, query: str) -> Column:
    """Number of the query's words of three letters or more that a term list holds, plus 4 for the whole query."""
    words = [w for w in query.lower().split() if len(w) >= 3]
    text = F.lower(F.array_join(terms, " "))
    return sum([F.contains(text, F.lit(w)).cast("int") for w in words], F.lit(0)) + F.when(F.contains(text, F.lit(query.lower())), 4).otherwise(0)


def expansion_terms(query: str) -> list[str]:
    """What a query is looked up by: itself, and its words of three letters or more that are no stop words."""
    whole = " ".join(query.lower().split())
    words = [w for w in re.findall(r"[a-z0-9]+", whole) if len(w) >= 3 and w not in STOP_WORDS]
    return list(dict.fromkeys([whole, *words])) if whole else []


def like_any(column: Column, terms: list[str]) -> Column:
    """Whether a column is LIKE any %term%; wildcards within terms are live."""
    hit = F.lit(False)
    for term in terms:
        hit = hit | F.lower(column).like(f"%{term}%")
    return hit


def snippet(text: Column, query: str, size: int = 48) -> Column:
    """The densest run of ``size`` tokens with the query's words in brackets, and ellipses where text is left out.

    Meant for the rows of one page. Ties go to the earliest run. How a full-text engine chooses among runs of equal
    density is its own affair, so this is close to, not the same as, such an engine's snippets.
    """
    words = F.array(*[F.lit(w) for w in query_terms(query)])
    parts = F.filter(F.split(text, "\\s+"), lambda p: p != "")
    hits = F.transform(parts, lambda p: F.size(F.array_intersect(search_tokens(p), words)) > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(parts) - size))
    scored = F.transform(starts, lambda i: F.struct((-F.size(F.filter(F.slice(hits, i + 1, size), lambda h: h))).alias("n"), i.alias("i")))
    at = F.array_min(scored)["i"]
    shown = F.transform(F.slice(F.arrays_zip(parts.alias("p"), hits.alias("h")), at + 1, size), lambda z: F.when(z["h"], F.concat(F.lit("["), z["p"], F.lit("]"))).otherwise(z["p"]))
    return F.concat(F.when(at > 0, F.lit(" … ")).otherwise(F.lit("")), F.array_join(shown, " "), F.when(at + size < F.size(parts), F.lit(" … ")).otherwise(F.lit("")))
