"""DuckDB statements that give the registered queries' results on their own terms."""

from __future__ import annotations

from checks.derived import BASE_PATH, BASE_URL, CURRENT_YEAR, ctes

# A URI by two anchored patterns; the engine splits the path instead.
PARSED = f"""
, pathed AS (
  SELECT *, CASE WHEN starts_with(akn_uri, 'http')
    THEN regexp_replace(url_decode(regexp_extract(akn_uri, '^https?://[^/?#]*([^?#;]*)', 1)), '^.*{BASE_PATH}', '')
    ELSE url_decode(akn_uri) END AS path
  FROM listing),
matched AS (
  SELECT *,
    regexp_matches(path, '^/akn/fi/doc/authority-regulation/[^/]+/[0-9]+/[^/]+/[^/]+$') AS is_auth,
    regexp_matches(path, '^/akn/fi/(act|judgment|doc)/[^/]+/[0-9]+/[^/]+/[^/]+$') AS is_std
  FROM pathed),
parsed AS (
  SELECT *, is_auth OR is_std AS ok,
    CASE WHEN is_auth THEN 'doc' WHEN is_std THEN split_part(path, '/', 4) END AS doc_category,
    CASE WHEN is_auth OR is_std THEN split_part(path, '/', 5) END AS doc_document_type,
    CASE WHEN is_auth THEN split_part(path, '/', 6) END AS doc_authority,
    CASE WHEN is_auth OR is_std THEN split_part(path, '/', -3) END AS doc_year,
    CASE WHEN is_auth OR is_std THEN split_part(path, '/', -2) END AS doc_number,
    CASE WHEN is_auth OR is_std THEN split_part(path, '/', -1) END AS doc_lang_and_version,
    CASE WHEN is_auth OR is_std THEN substr(path, 9) END AS folder_path,
    CASE WHEN is_auth OR is_std THEN path END AS api_path,
    CASE WHEN is_auth OR is_std THEN CAST(split_part(path, '/', -3) AS INTEGER) END AS year_int
  FROM matched)
"""
_INFO = "doc_category, doc_document_type, doc_authority, doc_year, doc_number, doc_lang_and_version"

# Document types by request, for act, doc, authority-regulation in that order.
_TYPES = """
, types(pass_no, requested, t_category, t_type) AS (VALUES
  (0, 'act', 'act', 'statute'), (1, 'act', 'act', 'statute-consolidated'), (2, 'act', 'act', 'statute-translated'),
  (3, 'act', 'act', 'statute-aland'), (4, 'act', 'act', 'statute-sami'),
  (5, 'doc', 'doc', 'government-proposal'), (6, 'doc', 'doc', 'treaty'), (7, 'doc', 'doc', 'treaty-consolidated'),
  (8, 'doc', 'doc', 'authority-regulation'), (9, 'authority-regulation', 'doc', 'authority-regulation'))
"""
_WINDOW = (
    f"(requested = 'act' AND year_int BETWEEN {CURRENT_YEAR - 4} AND {CURRENT_YEAR}"
    f" OR requested = 'doc' AND year_int BETWEEN {CURRENT_YEAR - 2} AND {CURRENT_YEAR}"
    f" OR requested = 'authority-regulation' AND year_int BETWEEN {CURRENT_YEAR - 1} AND {CURRENT_YEAR})"
)

# Last attempt of each request in its newest run.
_FINAL = """
, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY akn_uri, kind, link ORDER BY attempt DESC) AS back,
    count(*) OVER (PARTITION BY akn_uri, kind, link) AS attempts_used,
    min(start_ts) OVER (PARTITION BY akn_uri, kind, link) AS first_start,
    bool_and(exception IS NOT NULL OR http_status IN (429, 500, 502, 503, 504))
      OVER (PARTITION BY akn_uri, kind, link) AS all_retryable
  FROM (SELECT * FROM attempts
    QUALIFY run_id = max(run_id) OVER (PARTITION BY akn_uri, kind, link)) newest),
final AS (
  SELECT akn_uri, kind, link, run_id, http_status, exception, attempts_used,
    all_retryable AND attempts_used >= 6 AS exhausted, attempts_used > 6 AS over_budget, first_start AS start_ts
  FROM ranked WHERE back = 1)
"""

_DECIDED = """
, decided AS (
  SELECT w.*, x.http_status AS xml_status, x.exception AS xml_exception, x.akn_uri IS NOT NULL AS fetched,
    (SELECT min(start_ts) FROM final f WHERE f.akn_uri = w.akn_uri) AS first_ts,
    CASE WHEN NOT ok THEN 'error' WHEN i.folder_path IS NOT NULL THEN 'skipped'
      WHEN x.akn_uri IS NULL THEN NULL
      WHEN x.exception IS NOT NULL OR x.http_status <> 200 THEN 'error' ELSE 'success' END AS outcome
  FROM {work} w
  LEFT JOIN inventory i ON i.folder_path = w.folder_path
  LEFT JOIN final x ON x.akn_uri = w.akn_uri AND x.kind = 'xml'),
outcomes AS (
  SELECT *, CASE WHEN outcome <> 'error' THEN NULL WHEN NOT ok THEN 'Failed to parse URI: ' || akn_uri
    WHEN xml_exception IS NOT NULL THEN 'Failed to fetch XML: ' || xml_exception
    ELSE 'HTTP ' || xml_status || ' fetching XML' END AS error
  FROM decided),
stored AS (
  SELECT o.item_no, o.akn_uri, f.ord, 'corpus/' || o.folder_path || '/' || f.name AS file_path
  FROM outcomes o JOIN (
    SELECT akn_uri, CASE kind WHEN 'xml' THEN 0 WHEN 'pdf' THEN 1 WHEN 'zip' THEN 2 ELSE 3 END AS ord,
      CASE kind WHEN 'media' THEN 'media/' || regexp_extract(link, '[^/]+$') ELSE 'main.' || kind END AS name
    FROM final WHERE http_status = 200) f ON f.akn_uri = o.akn_uri
  WHERE o.outcome = 'success'
  UNION ALL
  SELECT item_no, akn_uri, 0, 'corpus/' || folder_path || '/main.xml' FROM outcomes WHERE outcome = 'skipped')
"""

# A run over all copies of every URI: the outcome is the URI's, the first
# completed copy ends it.
def _crawl(resume: bool = True, force: bool = False, dry_run: bool = False) -> str:
    todo = "WHERE akn_uri NOT IN (SELECT akn_uri FROM completed)" if resume else ""
    decided = _DECIDED.format(work="todo")
    if force:
        decided = decided.replace("ON i.folder_path = w.folder_path", "ON FALSE")
    if dry_run:
        decided = decided.replace("WHEN x.akn_uri IS NULL THEN NULL", "WHEN TRUE THEN 'dry-run'")
    return (
    ctes("listing", "completed", "inventory", "attempts")
    + PARSED
    + _TYPES
    + f"""
, scoped AS (
  SELECT p.* REPLACE (CAST(pass_no AS BIGINT) * 288230376151711744 + item_no AS item_no)
  FROM parsed p JOIN types ON category = t_category AND document_type = t_type
  WHERE (year_int IS NULL OR {_WINDOW}) AND (doc_lang_and_version IS NULL OR doc_lang_and_version = 'fin@')),
todo AS (SELECT * FROM scoped {todo})
"""
    + _FINAL
    + decided
    + """
, listed AS (
  SELECT item_no, akn_uri, outcome AS status, coalesce(first_ts, TIMESTAMP '2001-12-31 00:00:00') AS timestamp,
    coalesce((SELECT string_agg(file_path, '|' ORDER BY ord, file_path) FROM stored s WHERE s.item_no = o.item_no), '') AS files,
    error
  FROM outcomes o WHERE outcome IS NOT NULL
  QUALIFY coalesce(max(CASE WHEN outcome IN ('success', 'skipped') THEN 1 ELSE 0 END) OVER (
    PARTITION BY akn_uri ORDER BY item_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0)
"""
)


_CRAWL = _crawl()

_LINKS = (
    ctes("xml_corpus")
    + """
, links AS (
  SELECT doc_id, akn_uri, 'media/' || (doc_id % 7) || '.gif' AS link FROM xml_corpus
  WHERE lang IN ('en', 'fr') AND doc_id % 11 <> 0
  UNION ALL
  SELECT doc_id, akn_uri, 'media/' || side || '/' || (doc_id % 5) || '.pdf'
  FROM xml_corpus, (VALUES ('a'), ('b')) v(side) WHERE doc_id % 2 = 0 AND doc_id % 11 <> 0)
"""
)

_PAGES = (
    ctes("listing")
    + """
, placed AS (
  SELECT *, row_number() OVER (PARTITION BY category, document_type ORDER BY item_no) AS position FROM listing)
"""
)

_LIST_PAGES = (
    _PAGES
    + """
SELECT category, document_type, CAST((position - 1) // 2500 + 1 AS BIGINT) AS page,
  CAST((position - 1) % 2500 AS BIGINT) AS pos, akn_uri, status FROM placed
"""
)


def _stops(max_pages: int | None) -> str:
    limit = f"WHEN page > {max_pages} THEN 'max_pages'" if max_pages else ""
    # The page after the last allowed one stops a stream although it is never logged.
    extra = (
        f"UNION ALL SELECT stream_id, {max_pages} + 1, 200, TRUE, 10 FROM page_log GROUP BY stream_id"
        if max_pages
        else ""
    )
    return (
        ctes("page_log")
        + f"""
, pages AS (SELECT stream_id, page, http_status, json_ok, n_items FROM page_log {extra}),
tested AS (
  SELECT *, CASE {limit} WHEN http_status <> 200 THEN 'http_error' WHEN NOT json_ok THEN 'bad_json'
    WHEN n_items = 0 THEN 'empty' WHEN n_items < 10 THEN 'short' END AS reason
  FROM pages),
reached AS (SELECT stream_id, max(page) AS last_page FROM page_log GROUP BY stream_id),
stops AS (
  SELECT t.stream_id, min(page) AS stop_page, arg_min(reason, page) AS stop_reason
  FROM tested t JOIN reached r ON r.stream_id = t.stream_id
  WHERE reason IS NOT NULL AND page <= last_page + 1 GROUP BY t.stream_id)
"""
    )


_PROGRESS = (
    ctes("listing", "completed")
    + """
, placed AS (
  SELECT *, row_number() OVER (PARTITION BY category, document_type ORDER BY item_no) AS rn,
    akn_uri NOT IN (SELECT akn_uri FROM completed) AS processed FROM listing),
progress AS (
  SELECT category, document_type, max(rn) AS position, max(item_no) AS last_item
  FROM placed WHERE processed GROUP BY ALL)
"""
)

_MANIFEST = ctes("manifest")


def _sorted(order: str) -> str:
    return ctes("listing") + PARSED + f"SELECT item_no, akn_uri, row_number() OVER (ORDER BY {order}, item_no) AS place FROM parsed"


_GAPS = (
    ctes("request_log")
    + """, gaps AS (SELECT * REPLACE (CASE WHEN request_id % 7 <> 0 THEN end_ts END AS end_ts) FROM request_log)
      SELECT request_id, client_id, CAST(coalesce(greatest(0, 3600000000 - date_diff('microsecond',
        lag(end_ts) OVER (PARTITION BY client_id ORDER BY start_ts, request_id), start_ts)), 0) AS BIGINT) AS wait_us FROM gaps"""
)

ORACLES: dict[str, str] = {
    "normalise_path": ctes("listing") + PARSED + "SELECT item_no, path FROM parsed",
    "parse_uri": ctes("listing") + PARSED + f"SELECT item_no, ok AS parsed, {_INFO} FROM parsed",
    "parse_uri_sql": ctes("listing") + PARSED + f"SELECT item_no, {_INFO}, folder_path, api_path FROM parsed",
    "folder_path": ctes("listing") + PARSED + "SELECT item_no, folder_path FROM parsed",
    "api_path": ctes("listing") + PARSED + "SELECT item_no, api_path FROM parsed",
    "lang_version_split": ctes("listing")
    + PARSED
    + """SELECT item_no, split_part(doc_lang_and_version, '@', 1) AS lang,
         nullif(split_part(doc_lang_and_version, '@', 2), '') AS version,
         CAST(try_strptime(split_part(doc_lang_and_version, '@', 2), '%Y%m%d') AS DATE) AS version_date FROM parsed""",
    "media_basename": ctes("attempts")
    + "SELECT run_id, akn_uri, attempt, link, regexp_extract(link, '[^/]+$') AS basename FROM attempts WHERE link IS NOT NULL",
    "asset_plan": _LINKS
    + f""", kinds(kind, ord, suffix, name, accept) AS (VALUES
        ('xml', 0, '', 'main.xml', 'application/xml'), ('pdf', 1, '/main.pdf', 'main.pdf', 'application/pdf'),
        ('zip', 2, '/main.akn', 'main.zip', 'application/zip'))
      SELECT akn_uri, kind, ord, CAST(NULL AS VARCHAR) AS link, '{BASE_URL}' || akn_uri || suffix AS request_url,
        'corpus/' || substr(akn_uri, 9) || '/' || name AS file_path, accept FROM xml_corpus, kinds
      UNION ALL
      SELECT akn_uri, 'media', 3, link, '{BASE_URL}' || akn_uri || '/' || link,
        'corpus/' || substr(akn_uri, 9) || '/media/' || regexp_extract(link, '[^/]+$'), 'application/xml' FROM links""",
    "filter_category": ctes("listing")
    + "SELECT item_no, category, document_type FROM listing WHERE category = 'act' OR document_type = 'authority-regulation'",
    "filter_year_window": ctes("listing")
    + PARSED
    + _TYPES
    + f"""SELECT item_no, requested, year_int FROM parsed JOIN types
          ON category = t_category AND document_type = t_type WHERE {_WINDOW}""",
    "filter_lang": ctes("listing") + PARSED + "SELECT item_no, akn_uri FROM parsed WHERE doc_lang_and_version = 'fin@'",
    "filter_media_links": _LINKS + "SELECT link, count(*) AS n_documents FROM links GROUP BY link",
    "filter_completable": _MANIFEST + "SELECT item_no, akn_uri, status FROM manifest WHERE status IN ('success', 'skipped')",
    "filter_retryable": ctes("attempts")
    + "SELECT run_id, akn_uri, kind, link, attempt, http_status FROM attempts WHERE http_status IN (429, 500, 502, 503, 504)",
    "classify_response": ctes("attempts")
    + """SELECT run_id, akn_uri, kind, link, attempt, CASE WHEN http_status = 429 THEN 'rate_limited'
         WHEN http_status >= 400 THEN 'http_error' WHEN http_status IS NOT NULL THEN 'ok' END AS response_class FROM attempts""",
    "expand_types": ctes("listing")
    + _TYPES
    + """SELECT item_no, category, document_type, requested, CAST(pass_no AS BIGINT) AS pass_no
         FROM listing JOIN types ON category = t_category AND document_type = t_type""",
    "paginate": _PAGES + "SELECT item_no, position, CAST((position - 1) // 10 + 1 AS BIGINT) AS page FROM placed",
    "listing_stop": _stops(40)
    + """SELECT p.stream_id, page, CAST(CASE WHEN stop_page IS NULL OR page < stop_page OR stop_reason = 'short'
           THEN n_items ELSE 0 END AS BIGINT) AS items_kept, CAST(stop_page AS VARCHAR) AS stop_page, stop_reason
         FROM page_log p LEFT JOIN stops s ON s.stream_id = p.stream_id
         WHERE stop_page IS NULL OR page < stop_page OR (page = stop_page AND stop_reason <> 'max_pages')""",
    "listing_stop_points": _stops(None)
    + """SELECT r.stream_id, CAST(stop_page AS VARCHAR) AS stop_page, stop_reason FROM reached r LEFT JOIN stops s ON s.stream_id = r.stream_id""",
    "max_pages": ctes("page_log") + "SELECT stream_id, page, n_items FROM page_log WHERE page <= 7",
    "listing_sort": _sorted("TRY_CAST(doc_number AS BIGINT) DESC NULLS LAST, doc_number DESC NULLS LAST"),
    "listing_sort_number_up": _sorted("TRY_CAST(doc_number AS BIGINT) ASC NULLS LAST, doc_number ASC NULLS LAST"),
    "listing_sort_issued": _sorted("date_issued ASC NULLS LAST"),
    "listing_sort_modified": _sorted("modified DESC NULLS LAST"),
    "paginate_hashed": ctes("listing")
    + """, placed AS (
      SELECT item_no, row_number() OVER (PARTITION BY category, document_type
        ORDER BY (item_no * 7919 % 1000003) * 9000000000 + item_no) AS position FROM listing)
      SELECT item_no, position, CAST((position - 1) // 10 + 1 AS BIGINT) AS page FROM placed""",
    "listing_sort_top": ctes("listing")
    + PARSED
    + """SELECT item_no, akn_uri, doc_number AS number FROM parsed
         ORDER BY TRY_CAST(doc_number AS BIGINT) DESC NULLS LAST, doc_number DESC NULLS LAST, item_no LIMIT 500""",
    "union_listings": ctes("listing")
    + """SELECT item_no, category, document_type, akn_uri FROM listing WHERE category = 'act'
         UNION ALL SELECT item_no, category, document_type, akn_uri FROM listing WHERE category = 'doc'
         UNION ALL SELECT item_no, category, document_type, akn_uri FROM listing WHERE document_type = 'authority-regulation'""",
    "worklist": ctes("listing", "completed")
    + "SELECT item_no, akn_uri FROM listing WHERE akn_uri NOT IN (SELECT akn_uri FROM completed)",
    "worklist_bucketed": ctes("listing", "completed")
    + "SELECT item_no, akn_uri FROM listing WHERE akn_uri NOT IN (SELECT akn_uri FROM completed)",
    "skip_completed": ctes("listing", "completed")
    + "SELECT item_no, akn_uri FROM listing WHERE akn_uri IN (SELECT akn_uri FROM completed)",
    "in_run_dedup": ctes("listing")
    + """, tried AS (SELECT item_no, akn_uri, CASE WHEN item_no % 3 = 0 THEN 'error' ELSE 'success' END AS status FROM listing)
         SELECT item_no, akn_uri, status FROM tried
         QUALIFY coalesce(max(CASE WHEN status = 'success' THEN 1 ELSE 0 END) OVER (PARTITION BY akn_uri ORDER BY item_no
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0""",
    "existing_documents": ctes("listing", "inventory")
    + PARSED
    + "SELECT item_no, akn_uri, folder_path FROM parsed WHERE folder_path IN (SELECT folder_path FROM inventory)",
    "dry_run_plan": ctes("listing", "completed", "inventory")
    + PARSED
    + """SELECT item_no, akn_uri, folder_path AS target_folder FROM parsed
         WHERE ok AND akn_uri NOT IN (SELECT akn_uri FROM completed)
           AND folder_path NOT IN (SELECT folder_path FROM inventory)""",
    "final_response": ctes("attempts") + _FINAL + "SELECT * REPLACE (CAST(http_status AS VARCHAR) AS http_status) FROM final",
    "document_outcome": ctes("listing", "inventory", "attempts")
    + PARSED
    + _FINAL
    + _DECIDED.format(work="parsed")
    + "SELECT item_no, akn_uri, outcome, error, first_ts FROM outcomes",
    "document_files": ctes("listing", "inventory", "attempts")
    + PARSED
    + _FINAL
    + _DECIDED.format(work="parsed")
    + """SELECT item_no, akn_uri, CAST(row_number() OVER (PARTITION BY item_no ORDER BY ord, file_path) - 1 AS INTEGER) AS file_no,
         file_path FROM stored""",
    "pacing_audit": ctes("request_log")
    + """SELECT request_id, client_id, CAST(coalesce(greatest(0, 3600000000 - date_diff('microsecond',
           lag(end_ts) OVER (PARTITION BY client_id ORDER BY start_ts, request_id), start_ts)), 0) AS BIGINT) AS wait_us
         FROM request_log""",
    "pacing_gaps_narrow": _GAPS,
    "pacing_gaps_wide": _GAPS,
    "asset_warnings": ctes("attempts")
    + _FINAL
    + """SELECT akn_uri, kind, count(*) AS n_warnings FROM final
         WHERE kind IN ('pdf', 'zip') AND (exception IS NOT NULL OR http_status NOT IN (200, 404))
            OR kind = 'media' AND exception IS NOT NULL
         GROUP BY ALL""",
    "manifest_summary": _MANIFEST
    + """SELECT count(*) AS total, count(*) FILTER (WHERE status = 'success') AS success,
         count(*) FILTER (WHERE status = 'skipped') AS skipped, count(*) FILTER (WHERE status = 'error') AS error FROM manifest""",
    "manifest_header": _MANIFEST
    + """SELECT max(timestamp) AS updated_at, count(*) AS total_entries,
         count(*) FILTER (WHERE status = 'success') AS success_count, count(*) FILTER (WHERE status = 'skipped') AS skipped_count,
         count(*) FILTER (WHERE status = 'error') AS error_count FROM manifest""",
    "run_verdict": _MANIFEST
    + "SELECT CAST(CASE WHEN count(*) FILTER (WHERE status = 'error') = 0 THEN 0 ELSE 1 END AS INTEGER) AS exit_code FROM manifest",
    "completed_set": _MANIFEST + "SELECT DISTINCT akn_uri FROM manifest WHERE status IN ('success', 'skipped')",
    "last_uri": _MANIFEST
    + """SELECT akn_uri AS last_uri FROM manifest WHERE status IN ('success', 'skipped')
         ORDER BY timestamp DESC, item_no DESC LIMIT 1""",
    "session_times": _MANIFEST + "SELECT min(timestamp) AS started_at, max(timestamp) AS updated_at FROM manifest",
    "progress_counter": _PROGRESS + "SELECT category, document_type, position FROM progress",
    "resume_position": _PROGRESS
    + """SELECT category, document_type,
         CASE WHEN last_item = (SELECT max(last_item) FROM progress) THEN position ELSE 1 END AS resume_at FROM progress""",
    "manifest_latest": _MANIFEST
    + """SELECT item_no, akn_uri, status, timestamp, error FROM manifest
         QUALIFY row_number() OVER (PARTITION BY akn_uri ORDER BY timestamp DESC, item_no DESC) = 1""",
    "set_add": ctes("completed", "manifest")
    + """SELECT akn_uri FROM completed UNION
         SELECT akn_uri FROM manifest WHERE status IN ('success', 'skipped')""",
    "append_manifest": _CRAWL
    + f", history AS ({ctes('manifest')} SELECT item_no, akn_uri, status, timestamp, error FROM manifest) "
    + "SELECT * FROM history UNION ALL SELECT item_no, akn_uri, status, timestamp, error FROM listed",
    "media_links": _LINKS + "SELECT doc_id, link FROM links",
    "media_asset_rows": _LINKS
    + """SELECT x.doc_id, link, regexp_extract(link, '[^/]+$') AS basename,
         'corpus/' || substr(x.akn_uri, 9) || '/media/' || regexp_extract(link, '[^/]+$') AS file_path
         FROM xml_corpus x LEFT JOIN links l ON l.doc_id = x.doc_id""",
    "media_collisions": _LINKS
    + """SELECT doc_id, regexp_extract(link, '[^/]+$') AS basename, count(*) AS n_links
         FROM links GROUP BY ALL HAVING count(*) > 1""",
    "frbr_metadata": ctes("xml_corpus")
    + """, sound AS (SELECT doc_id, lang, doc_id % 11 <> 0 AS ok, CAST(doc_id AS VARCHAR) AS n FROM xml_corpus)
      SELECT doc_id,
        CASE WHEN ok THEN '/akn/w/' || n || '/!main' END AS work_this, CASE WHEN ok THEN '/akn/w/' || n END AS work_uri,
        CASE WHEN ok THEN 'urn:eli:' || n END AS work_eli,
        CASE WHEN ok THEN '/akn/e/' || n END AS expression_this, CAST(NULL AS VARCHAR) AS expression_uri,
        CAST(NULL AS VARCHAR) AS expression_eli, CAST(NULL AS VARCHAR) AS manifestation_this,
        CASE WHEN ok THEN '/akn/m/' || n || '.akn' END AS manifestation_uri, CAST(NULL AS VARCHAR) AS manifestation_eli,
        CASE WHEN ok THEN make_date(2024, 1 + doc_id % 9, 15) END AS date_issued,
        CASE WHEN ok THEN make_date(2024, 10 + doc_id % 3, 20) END AS date_published,
        CASE WHEN ok THEN 'statute' END AS subtype, CASE WHEN ok THEN n END AS number,
        CASE WHEN ok THEN lang END AS language, CASE WHEN ok THEN CAST(2015 + doc_id % 8 AS VARCHAR) END AS document_year
      FROM sound""",
    "crawl_manifest": _CRAWL + "SELECT * FROM listed",
    "crawl_report": _CRAWL
    + """SELECT count(*) AS total, count(*) FILTER (WHERE status = 'success') AS success,
         count(*) FILTER (WHERE status = 'skipped') AS skipped, count(*) FILTER (WHERE status = 'error') AS error,
         CAST(CASE WHEN count(*) FILTER (WHERE status = 'error') = 0 THEN 0 ELSE 1 END AS INTEGER) AS exit_code FROM listed""",
    "crawl_no_resume": _crawl(resume=False) + "SELECT * FROM listed",
    "crawl_force": _crawl(force=True) + "SELECT * FROM listed",
    "crawl_dry_run": _crawl(dry_run=True) + "SELECT * FROM listed",
    # A second run finds completed what the first has not failed at.
    "run_crawl_resume": _CRAWL
    + """SELECT '007' AS run_id, item_no, akn_uri, status, error FROM listed
         UNION ALL SELECT '008', item_no, akn_uri, status, error FROM listed WHERE status = 'error'""",
    "run_crawl_reset": f"""SELECT '007' AS run_id, item_no, akn_uri, status, error FROM ({_CRAWL} SELECT * FROM listed)
         UNION ALL SELECT '008', item_no, akn_uri, status, error FROM ({_crawl(resume=False)} SELECT * FROM listed)""",
    "run_crawl_report": f"""SELECT count(*) AS total, count(*) FILTER (WHERE status = 'success') AS success,
         count(*) FILTER (WHERE status = 'skipped') AS skipped, count(*) FILTER (WHERE status = 'error') AS error,
         CAST(CASE WHEN count(*) FILTER (WHERE status = 'error') = 0 THEN 0 ELSE 1 END AS INTEGER) AS exit_code FROM (
         SELECT status FROM ({_CRAWL} SELECT * FROM listed)
         UNION ALL SELECT status FROM ({_crawl(resume=False)} SELECT * FROM listed))""",
    "run_crawl_progress": f"""SELECT run_id, category, document_type, max(rn) AS position FROM (
         SELECT run_id, category, document_type, akn_uri, done,
           row_number() OVER (PARTITION BY run_id, category, document_type ORDER BY item_no) AS rn
         FROM ({_CRAWL} SELECT *, akn_uri IN (SELECT akn_uri FROM completed) AS done FROM scoped), (VALUES ('007'), ('008')) v(run_id))
       WHERE run_id = '008' OR NOT done GROUP BY ALL""",
    "pending_documents": _CRAWL
    + """SELECT item_no - (item_no // 288230376151711744) * 288230376151711744 AS item_no, akn_uri,
         'corpus/' || folder_path AS target_folder FROM todo
         WHERE ok AND folder_path NOT IN (SELECT folder_path FROM inventory)""",
    "read_list_pages": _LIST_PAGES,
    "listed_items": _LIST_PAGES,
    "file_inventory": ctes("xml_corpus")
    + """SELECT DISTINCT 'run_id=001/category=act/document_type=statute/year=' || CAST(2015 + doc_id % 8 AS VARCHAR) AS folder,
         TRUE AS filled FROM xml_corpus""",
    "read_document_tree": ctes("xml_corpus")
    + """SELECT substr(akn_uri, 9) AS folder_path, 1::BIGINT AS files, md5(xml) AS xml_md5,
         octet_length(encode(xml)) + 1 <= 8192 AS as_text FROM xml_corpus""",
    "stored_documents": ctes("xml_corpus")
    + "SELECT doc_id, substr(akn_uri, 9) AS folder_path FROM xml_corpus WHERE doc_id % 2 = 0",
    "read_state": _MANIFEST + "SELECT DISTINCT akn_uri FROM manifest WHERE status IN ('success', 'skipped')",
    "read_state_progress": _MANIFEST
    + """SELECT 'act' AS category, 'type-' || year(timestamp) AS document_type, count(*) AS position,
         max(timestamp) AS updated_at FROM manifest GROUP BY year(timestamp), day(timestamp)""",
    "read_progress": _PROGRESS
    + """SELECT category, document_type, position + extra AS position, TIMESTAMP '2001-12-31 00:00:00' AS updated_at, run_id
         FROM progress, (VALUES ('007', 0), ('008', 1)) v(run_id, extra)""",
    "reset_state": _MANIFEST + "SELECT DISTINCT akn_uri FROM manifest WHERE status = 'skipped'",
    "manifest_report": _MANIFEST
    + """SELECT count(*) AS total, count(*) FILTER (WHERE status = 'success') AS success,
         count(*) FILTER (WHERE status = 'skipped') AS skipped, count(*) FILTER (WHERE status = 'error') AS error,
         CAST(CASE WHEN count(*) FILTER (WHERE status = 'error') = 0 THEN 0 ELSE 1 END AS INTEGER) AS exit_code FROM manifest""",
    "read_manifest": _MANIFEST + "SELECT akn_uri, status, timestamp, akn_uri AS files, error FROM manifest",
    "write_manifest": _MANIFEST
    + """SELECT CASE WHEN status = 'error' THEN '007' ELSE '2026-02-01' END AS run_id, item_no, akn_uri, status, timestamp
         FROM manifest""",
    "read_completed": _MANIFEST + "SELECT DISTINCT akn_uri FROM manifest WHERE status IN ('success', 'skipped')",
    "write_corpus": ctes("xml_corpus")
    + """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '002' ELSE '001' END AS run_id, 'act' AS category,
         'statute' AS document_type, CAST(2015 + doc_id % 8 AS VARCHAR) AS year,
         md5(CASE WHEN doc_id % 3 = 0 THEN xml || '<!-- again -->' ELSE xml END) AS xml_md5 FROM xml_corpus""",
    "stream_listing": _LIST_PAGES,
    "stream_dedup": ctes("listing", "completed")
    + "SELECT DISTINCT akn_uri FROM listing WHERE akn_uri NOT IN (SELECT akn_uri FROM completed)",
    "stream_until_done": ctes("listing", "completed")
    + """, tried AS (SELECT item_no, akn_uri, CASE WHEN item_no % 3 = 0 THEN 'error' ELSE 'success' END AS status,
           CASE WHEN item_no >= 1000000000 THEN 2 ELSE item_no % 2 END AS batch FROM listing
           WHERE akn_uri NOT IN (SELECT akn_uri FROM completed WHERE akn_uri LIKE '%7%'))
         SELECT item_no, akn_uri, status FROM tried
         QUALIFY coalesce(max(CASE WHEN status = 'success' THEN 1 ELSE 0 END) OVER (PARTITION BY akn_uri ORDER BY batch, item_no
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0""",
    "stream_counts": _MANIFEST + "SELECT status, count(*) AS entries FROM manifest GROUP BY status",
    "stream_manifest": _MANIFEST + "SELECT item_no, akn_uri, status, timestamp FROM manifest",
    "stream_progress": ctes("listing") + "SELECT category, document_type, count(*) AS items_seen FROM listing GROUP BY ALL",
    "stream_crawl": _CRAWL + "SELECT * FROM listed",
}
