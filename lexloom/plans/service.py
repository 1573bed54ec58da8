"""The service's questions over a compact schema that the driver's tables are cut into, each with its DuckDB equivalent."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.operators import relational, search, service
from lexloom.plans import tables
from lexloom.plans.tables import query

#: Every table as SQL that both engines read alike: three documents in a row are the printed versions of one section.
_K = "CAST(floor(doc_id / 3) AS BIGINT)"
_KEY = f"CAST(2021 + 2 * ({_K} % 2) AS INT) AS edition_year, CAST(1 + {_K} % 90 AS STRING) || '.' || CAST(100 + CAST(floor({_K} / 90) AS BIGINT) % 9900 AS STRING) AS ors_section"
_TARGET = "CAST(1 + user_id % 90 AS STRING) || '.100'"
_CHAPTER = "CAST(1 + CAST(floor(p_partkey / 2) AS BIGINT) AS STRING)"
_EDITION = "CAST(2021 + 2 * (p_partkey % 2) AS INT)"
_URL = f"'http://law.example/' || CAST({_EDITION} AS STRING) || '/' || {_CHAPTER}"
COMPACT = {
    "editions": "SELECT DISTINCT CAST(2021 + 2 * (doc_id % 2) AS INT) AS edition_year FROM documents",
    "chapters": f"SELECT {_CHAPTER} AS chapter_number FROM part WHERE p_partkey < 160",
    "sections": f"SELECT {_KEY}, CAST(1 + {_K} % 90 AS STRING) AS chapter_number, lang AS status FROM documents WHERE doc_id % 3 = 0",
    "section_versions": f"SELECT {_KEY}, doc_id % 3 AS version_ordinal, split_part(text, '\n', 1) AS catchline, substr(text, length(split_part(text, '\n', 1)) + 2) AS content_text, lang AS status FROM documents",
    "section_notes": f"SELECT {_KEY}, doc_id AS id, 'quality ' || CAST(quality AS STRING) AS note_text FROM labels",
    "chapter_sources": f"SELECT {_EDITION} AS edition_year, {_CHAPTER} AS chapter_number, {_URL} AS source_url FROM part WHERE p_partkey < 160",
    "sources": f"SELECT {_URL} AS source_url, p_brand AS publisher FROM part WHERE p_partkey < 160",
    "amendments": f"SELECT 'a' || CAST(event_id AS STRING) AS id, 2000 + user_id % 24 + event_id % 2 AS session_year, {_TARGET} AS affected_ors_section, event_type AS action_type, repeat(props, CAST(1 + event_id % 90 AS INT)) AS raw_diff_text FROM events",
    "amendment_sources": "SELECT 'a' || CAST(event_id AS STRING) AS amendment_id, user_id AS session_law_chapter FROM events WHERE event_id % 3 <> 0",
    "amendment_context": "SELECT 'a' || CAST(event_id AS STRING) AS amendment_id, props AS condition_text, event_type AS operative_text FROM events WHERE event_type = 'error'",
    "pending_changes": f"SELECT 'p' || CAST(event_id AS STRING) AS id, {_TARGET} AS target_section, CASE WHEN event_id % 4 <> 0 THEN CAST(CAST(ts AS DATE) AS STRING) END AS effective_date FROM events",
    "pending_change_sources": "SELECT 'p' || CAST(event_id AS STRING) AS pending_change_id, CAST(2021 + 2 * (event_id % 2) AS INT) AS edition_year FROM events WHERE event_id % 5 <> 0",
    "diagnostics": "SELECT doc_id FROM labels WHERE toxic = 1",
    "diagnostic_reviews": "SELECT CASE WHEN quality = 1 THEN 'expected_scope' ELSE 'review_required' END AS disposition FROM labels",
    "build_metadata": "SELECT CASE WHEN n_nationkey = 0 THEN 'manifest' ELSE 'k' || CAST(n_nationkey AS STRING) END AS key, n_name AS value FROM nation",
}
_SQL = {name: f"({sql})" for name, sql in COMPACT.items()}


def compact(t, spark):
    """Reader of the compact tables over the driver's."""

    def read(name: str) -> DataFrame:
        source = COMPACT[name].split(" FROM ")[1].split()[0]
        return spark.sql(COMPACT[name].replace(f" FROM {source}", " FROM {rows}"), rows=t(source))

    return read


_SHOWN = f"""SELECT v.ors_section, v.edition_year, v.chapter_number, v.version_ordinal, v.status, md5(v.catchline) AS catchline_md5, {{excerpt}}round(v.score, 6) AS rank, s.source_url,
'ors:' || v.edition_year || ':' || v.ors_section || ':v' || v.version_ordinal AS id FROM v LEFT JOIN {_SQL["chapter_sources"]} s ON s.edition_year = v.edition_year AND s.chapter_number = v.chapter_number
ORDER BY v.score, v.edition_year DESC, v.ors_section, v.version_ordinal LIMIT 21"""
_RANKED = f", v AS (SELECT {_KEY}, CAST(1 + {_K} % 90 AS STRING) AS chapter_number, doc_id % 3 AS version_ordinal, lang AS status, catchline, score FROM r) "


def _answer(found: DataFrame, *more) -> DataFrame:
    return found.select("ors_section", "edition_year", "chapter_number", "version_ordinal", "status", F.md5(F.col("catchline").cast("binary")).alias("catchline_md5"), *more, F.round("rank", 6).alias("rank"), "source_url", "id")


@query(tables._bm25_sql(["with", "from"], _RANKED + "SELECT * FROM (" + _SHOWN.format(excerpt="").replace("FROM v LEFT", "FROM (SELECT * FROM v WHERE edition_year = 2023) v LEFT") + ")", "doc_id, lang, catchline", rounded=False))
def service_search(t, spark):
    """Sections of one edition by words, ranked within the whole table, with their sources."""
    return _answer(service.search_sections(compact(t, spark), "with from", edition=2023, limit=20))


@query(f"""WITH v AS (SELECT *, split_part(ors_section, '.', 1) AS chapter_number, 0.0::DOUBLE AS score FROM {_SQL["section_versions"]} WHERE ors_section = '5.100') """ + _SHOWN.format(excerpt="md5(substr(v.content_text, 1, 400)) AS excerpt_md5, "))
def service_lookup(t, spark):
    """A citation's printed versions with the start of their texts."""
    return _answer(service.search_sections(compact(t, spark), " ors 5.100", chapter="5", limit=20), F.md5(F.col("excerpt").cast("binary")).alias("excerpt_md5"))


@query(f"""SELECT 'ors:2021:5.100' AS id, s.chapter_number, s.status,
(SELECT string_agg(version_ordinal || ' ' || status || ' ' || md5(content_text), ',' ORDER BY version_ordinal, catchline) FROM {_SQL["section_versions"]} v WHERE v.ors_section = s.ors_section AND v.edition_year = s.edition_year) AS versions,
coalesce((SELECT string_agg(id || ' ' || note_text, ',' ORDER BY id) FROM {_SQL["section_notes"]} n WHERE n.ors_section = s.ors_section AND n.edition_year = s.edition_year), '') AS notes,
coalesce((SELECT string_agg(c.source_url || ' ' || publisher, ',' ORDER BY c.source_url) FROM {_SQL["chapter_sources"]} c JOIN {_SQL["sources"]} x ON x.source_url = c.source_url WHERE c.edition_year = s.edition_year AND c.chapter_number = s.chapter_number), '') AS sources
FROM {_SQL["sections"]} s WHERE s.ors_section = '5.100' AND s.edition_year = 2021""")
def service_section(t, spark):
    """A section with its versions, notes and sources in order."""
    joined = lambda name, item: F.array_join(F.transform(name, item), ",").alias(name)
    versions = joined("versions", lambda v: F.concat_ws(" ", v["version_ordinal"], v["status"], F.md5(v["content_text"].cast("binary"))))
    notes, sources = joined("notes", lambda n: F.concat_ws(" ", n["id"], n["note_text"])), joined("sources", lambda s: F.concat_ws(" ", s["source_url"], s["publisher"]))
    return service.get_section(compact(t, spark), "5.100", 2021).select("id", "section.chapter_number", "section.status", versions, notes, sources)


@query(f"""SELECT a.id, session_year, affected_ors_section, action_type, substr(raw_diff_text, 1, 500) AS raw_diff_text, length(raw_diff_text) > 500 AS text_truncated, session_law_chapter, condition_text
FROM {_SQL["amendments"]} a LEFT JOIN {_SQL["amendment_sources"]} s ON s.amendment_id = a.id LEFT JOIN {_SQL["amendment_context"]} c ON c.amendment_id = a.id
WHERE affected_ors_section = '5.100' ORDER BY session_year, a.id LIMIT 101 OFFSET 3""")
def service_amendments(t, spark):
    """A section's amendments with source and context, long wordings cut."""
    return service.get_amendments(compact(t, spark), "5.100", limit=100, offset=3).drop("operative_text")


@query(f"""SELECT id, target_section, effective_date, edition_year FROM {_SQL["pending_changes"]} p LEFT JOIN {_SQL["pending_change_sources"]} s ON s.pending_change_id = p.id
WHERE target_section = '5.100' AND edition_year = 2023 ORDER BY effective_date NULLS FIRST, id LIMIT 11""")
def service_pending(t, spark):
    """A section's pending changes, unknown dates first."""
    return service.get_pending_changes(compact(t, spark), "5.100", edition=2023)


@query(f"""SELECT 'edition' AS part, edition_year::VARCHAR AS name, NULL::VARCHAR AS value FROM {_SQL["editions"]}
UNION ALL """ + " UNION ALL ".join(f"SELECT 'count', '{n}', count(*)::VARCHAR FROM {_SQL[n]}" for n in service.COUNTED) + f"""
UNION ALL SELECT DISTINCT 'session_year', session_year::VARCHAR, NULL FROM {_SQL["amendments"]}
UNION ALL SELECT 'build', CASE key WHEN 'manifest' THEN 'manifest_sha256' ELSE key END, CASE key WHEN 'manifest' THEN sha256(value) ELSE value END FROM {_SQL["build_metadata"]}
UNION ALL SELECT 'review', disposition, count(*)::VARCHAR FROM {_SQL["diagnostic_reviews"]} GROUP BY disposition
UNION ALL VALUES ('limit', 'max_page_size', '100'), ('limit', 'max_query_length', '300')""")
def service_info(t, spark):
    """The snapshot described."""
    return service.dataset_info(compact(t, spark))


@query(tables.ORACLES["bm25_search"].replace("SELECT doc_id, lang, source, score FROM r", "SELECT doc_id, score FROM r"))
def bm25_indexed(t, spark):
    """The same ranking from a written index, of which the words' postings are read."""
    path = f"{relational.shared_folder(spark)}/index-{uuid.uuid4().hex}"
    search.write_ranked_index(tables._sections(t), "doc_id", ["catchline", "content"], path)
    found = search.ranked(spark, path, {"catchline": 5.0, "content": 1.0}, "with from")
    return search.page(found.select(F.col("key").alias("doc_id"), F.round("score", 6).alias("score")), ["score", "doc_id"], 20)


@query("""WITH w AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+')) AS words FROM documents)
SELECT doc_id FROM w WHERE list_contains(words, 'with') AND list_contains(words, 'from') AND list_contains(words, 'the')""")
def and_search_indexed(t, spark):
    """The words' lists of the inverted index intersected block by block."""
    return search.and_search_index(search.inverted_index(t("documents"), "doc_id", ["text"], block=128), "the With FROM").select(F.col("id").alias("doc_id"))
