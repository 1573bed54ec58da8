"""Terms and synonyms: rows from expansions, idempotent definition keys, upserts, and query expansion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.operators import search

#: Shape of an expansion payload (fixed names).
PAYLOAD = "layperson_questions array<string>, colloquial_synonyms map<string,array<string>>, legal_terms_of_art array<string>"


def prompt(citation: Column, title: Column, text: Column, definitions: Column) -> Column:
    """What a model is asked for one text (M34): the text, its definitions (array of struct term, wording), the reply's shape."""
    known = F.array_join(F.transform(definitions, lambda d: F.concat(F.lit('- "'), d["defined_term"], F.lit('": '), d["definition_text"])), "\n")
    shape = 'Reply with one JSON object and nothing else: "layperson_questions" (3 to 5 everyday questions), "colloquial_synonyms" (legal term to everyday phrases), "legal_terms_of_art" (list).'
    return F.concat_ws(
        "\n", F.concat(F.lit("Citation: "), citation), F.concat(F.lit("Title: "), F.coalesce(title, F.lit("(untitled)"))), F.lit("Text:"), text,
        F.when(F.size(definitions) > 0, F.concat(F.lit("Definitions:\n"), known)), F.lit(shape),
    )


def parse_payload(reply: Column) -> Column:
    """A model's reply to a payload struct, with or without a code fence; null where it is no such JSON."""
    fenced = F.regexp_extract(reply, "(?s)```(?:json)?\\s*(\\{.*\\})\\s*```", 1)
    return F.from_json(F.when(fenced != "", fenced).otherwise(F.trim(reply)), PAYLOAD)


def is_valid_payload(p: Column) -> Column:
    """Three to five questions, a list of terms, and at least one term with phrases; nothing blank."""
    filled = lambda a: F.forall(a, lambda x: F.coalesce(F.trim(x) != "", F.lit(False)))
    entries = F.map_entries(p["colloquial_synonyms"])
    mapped = (F.size(entries) > 0) & F.forall(entries, lambda e: (F.trim(e["key"]) != "") & (F.size(e["value"]) > 0) & filled(e["value"]))
    ok = F.size(p["layperson_questions"]).between(3, 5) & filled(p["layperson_questions"]) & filled(p["legal_terms_of_art"]) & mapped
    return F.coalesce(ok, F.lit(False))


def synonym_rows(expanded: DataFrame) -> DataFrame:
    """expanded(citation, payload, first_definition) -> citation, canonical_term, layperson_synonym, query_context.

    Synonyms hang on their own term; questions on the payload's first term, else the first definition, else the
    citation; terms of art on themselves, unless the synonyms cover them.
    """
    entries = F.map_entries("payload.colloquial_synonyms")
    base = expanded.withColumn("_entries", entries).withColumn("_primary", F.coalesce(F.get("_entries", F.lit(0))["key"], "first_definition", "citation"))
    pairs = base.select("citation", F.explode("_entries").alias("e")).select("citation", F.col("e.key").alias("canonical_term"), F.explode("e.value").alias("layperson_synonym"), F.lit("synonym").alias("query_context"))
    questions = base.select("citation", F.col("_primary").alias("canonical_term"), F.explode("payload.layperson_questions").alias("layperson_synonym"), F.lit("layperson_question").alias("query_context"))
    own = F.filter("payload.legal_terms_of_art", lambda t: ~F.array_contains(F.map_keys("payload.colloquial_synonyms"), t))
    terms = base.select("citation", F.explode(own).alias("canonical_term")).select("citation", "canonical_term", F.col("canonical_term").alias("layperson_synonym"), F.lit("legal_term_of_art").alias("query_context"))
    return pairs.unionByName(questions).unionByName(terms)


def first_definitions(definitions: DataFrame, order: str) -> DataFrame:
    """citation, first_definition: the first defined term of each, by ``order``."""
    ranked = definitions.withColumn("_n", F.row_number().over(Window.partitionBy("citation").orderBy(order))).filter("_n = 1")
    return ranked.select("citation", F.col("defined_term").alias("first_definition"))


def with_definition_keys(rows: DataFrame, definitions: DataFrame) -> DataFrame:
    """Synonym rows with a key per defined term that has none yet; running it again adds nothing."""
    key = ["citation", "canonical_term", "layperson_synonym"]
    term = F.col("defined_term")
    wanted = definitions.select("citation", term.alias("canonical_term"), term.alias("layperson_synonym"), F.lit("definition").alias("query_context")).distinct()
    return rows.unionByName(wanted.join(rows.select(*key), key, "left_anti").select(*rows.columns))


def upserted(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old with all rows of the keys in new replaced by new's."""
    return old.join(new.select(key).distinct(), key, "left_anti").select(*new.columns).unionByName(new)


def matches(rows: DataFrame, query: str) -> DataFrame:
    """The synonym rows whose term or phrase is LIKE the query or one of its words."""
    terms = search.expansion_terms(query)
    return rows.filter(search.like_any(F.col("canonical_term"), terms) | search.like_any(F.col("layperson_synonym"), terms))


def expand_query(rows: DataFrame, query: str) -> DataFrame:
    """One row: ascending distinct terms, citations and phrases of a query's matches; empty arrays for none."""
    pick = lambda c: F.array_sort(F.collect_set(c))
    found = matches(rows, query)
    return found.agg(pick("canonical_term").alias("matched_canonical_terms"), pick("citation").alias("ors_citations"), pick("layperson_synonym").alias("alternative_phrases"))
