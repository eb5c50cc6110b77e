"""Independent SQL (DuckDB dialect) for each registered query.

Each string runs on the driver tables registered as views.  The shared
building blocks below restate the fixture views of ``vellum.plans.fixtures``
and the reference's SQL semantics in plain SQL; the Spark side computes the
same through its own operators (pandas-UDF extraction, streaming T2, lake
files), so a match checks those operators end to end.
"""

from __future__ import annotations

CTE = {
    "stage_files": """
  SELECT 'manuals/' || CAST(page_id % 200 AS VARCHAR) || '_Manual-' || CAST(page_id // 200 + 1 AS VARCHAR) ||
         CASE WHEN page_id % 3 = 0 THEN '.pdf' WHEN page_id % 3 = 1 THEN '.PDF' ELSE '.html' END AS relative_path,
         url AS file_url,
         CAST(strlen(html) AS BIGINT) AS size,
         CAST(DATE '2024-01-01' + CAST(page_id % 30 AS INTEGER) AS TIMESTAMP) AS last_modified,
         html
  FROM pages""",
    "raw_catalog": """
  SELECT split_part(relative_path, '/', -1) AS file_name, relative_path, file_url,
         '@docs_stage/' || relative_path AS scoped_url, size, last_modified,
         CAST(NULL AS VARCHAR) AS extracted, html
  FROM stage_files WHERE relative_path ILIKE '%.pdf'""",
    "processed": """
  SELECT regexp_replace(file_name, '\\.pdf$', '', 'i') AS pdf_id, file_name, relative_path, file_url, last_modified,
         CASE WHEN regexp_matches(html, '<title>[^<]*</title>')
              THEN CAST(json_object('title', regexp_extract(html, '<title>([^<]*)</title>', 1)) AS VARCHAR)
              ELSE '{}' END AS pdf_metadata,
         CAST(1 AS DECIMAL(38,0)) AS page_count,
         regexp_replace(html, '<[^>]+>', ' ', 'g') AS extracted_text
  FROM raw_catalog""",
    "ontime": """
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(quarter(l_shipdate) AS INTEGER) AS quarter,
         CAST(month(l_shipdate) AS INTEGER) AS month,
         CAST(date_diff('day', o_orderdate, l_shipdate) AS INTEGER) AS arr_delay,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS cancelled
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "stats": """
  SELECT year, quarter, avg(arr_delay) AS avg_arr_delay, CAST(avg(cancelled) AS DOUBLE) AS cancel_rate
  FROM ontime WHERE year = 1999 AND quarter = 3 GROUP BY year, quarter""",
    "stats_empty": """
  SELECT year, quarter, avg(arr_delay) AS avg_arr_delay, CAST(avg(cancelled) AS DOUBLE) AS cancel_rate
  FROM ontime WHERE year = 1899 AND quarter = 3 GROUP BY year, quarter""",
    "media_summary": """
  SELECT CAST(page_id % 100 AS VARCHAR) AS product_id, count(*) AS media_count,
         min(url) AS first_media_url, max(url) AS last_media_url
  FROM pages GROUP BY 1""",
    "returns_summary": """
  SELECT CAST(l_partkey AS VARCHAR) AS product_id, count(*) AS return_count, sum(l_quantity) AS return_qty
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1""",
    "curated": """
  SELECT d.product_id, p.p_brand AS brand, p.p_name AS model_name,
         p.p_type AS category, d.doc_id AS review_id, CAST(o.o_orderdate AS DATE) AS review_date,
         l.quality AS rating, d.text AS review_text, n.n_name AS reviewer_location_name,
         CASE WHEN c.c_nationkey IS NOT NULL THEN
           'POINT(' || CAST(CAST(c.c_nationkey AS DOUBLE) * 10.0 - 120.0 AS VARCHAR) || ' ' ||
           CAST(CAST(c.c_nationkey AS DOUBLE) * 3.0 - 36.0 AS VARCHAR) || ')' END AS reviewer_geo_point,
         coalesce(m.media_count, 0) AS media_count, coalesce(m.first_media_url, 'NO MEDIA') AS first_media_url,
         coalesce(r.return_count, 0) AS return_count, CAST(coalesce(r.return_qty, 0.0) AS DOUBLE) AS return_qty
  FROM (SELECT *, CASE WHEN doc_id % 11 = 0 THEN 'gone-' ELSE '' END || CAST(doc_id % 150 AS VARCHAR) AS product_id
        FROM documents) d
  LEFT JOIN part p ON CAST(p.p_partkey AS VARCHAR) = d.product_id
  LEFT JOIN labels l ON l.doc_id = d.doc_id
  LEFT JOIN orders o ON o.o_orderkey = d.doc_id
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN media_summary m ON m.product_id = d.product_id
  LEFT JOIN returns_summary r ON r.product_id = d.product_id""",
}

_DEPS = {
    "stage_files": [], "raw_catalog": ["stage_files"], "processed": ["raw_catalog"],
    "ontime": [], "stats": ["ontime"], "stats_empty": ["ontime"],
    "media_summary": [], "returns_summary": [],
    "curated": ["media_summary", "returns_summary"],
}


def _with(*names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        for d in _DEPS[n]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n]}\n)" for n in order) + "\n"


RAW_COLS = "file_name, relative_path, file_url, scoped_url, size, last_modified, extracted"
PROCESSED_COLS = "pdf_id, file_name, relative_path, file_url, last_modified, pdf_metadata, page_count, extracted_text"


def _final_sql(stats_cte: str, where: str = "", order: str = "") -> str:
    return _with("processed", "curated", stats_cte) + f"""
SELECT * FROM (
  SELECT c.product_id, c.brand, c.model_name, c.category, c.review_date,
         CAST(year(c.review_date) AS INTEGER) AS review_year,
         CAST(month(c.review_date) AS INTEGER) AS review_month,
         CAST(day(c.review_date) AS INTEGER) AS review_day,
         c.rating, c.review_text, c.reviewer_location_name, c.reviewer_geo_point,
         p.pdf_id, p.file_name, p.relative_path, p.file_url, p.last_modified,
         p.pdf_metadata, p.page_count, p.extracted_text,
         s.avg_arr_delay, s.cancel_rate
  FROM processed p
  LEFT JOIN curated c ON c.product_id = split_part(p.pdf_id, '_', 1)
  LEFT JOIN {stats_cte} s ON 1 = 1
) v {where} {order}"""


# Inner arrays hold one element each, which names its level; every tenth product has an empty leaf array.
_INNER = ", ".join(f"CAST(0 AS INTEGER) AS pos{i}" for i in range(1, 8)) + ", " + ", ".join(
    f"CAST({i} AS INTEGER) AS level_{i}" for i in range(1, 8))
_FLATTEN = f"""
SELECT p_partkey, {_INNER}, CAST(g.pos AS INTEGER) AS pos, CAST(p_size + g.pos AS INTEGER) AS value, p_brand AS brand
FROM part, (VALUES (0), (1)) g(pos) WHERE p_partkey % 10 <> 0
UNION ALL
SELECT p_partkey, {_INNER}, CAST(NULL AS INTEGER), CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR)
FROM part WHERE p_partkey % 10 = 0"""

_MONTHLY = _with("ontime") + """
SELECT year, quarter, month, count(*) AS n_flights, count(arr_delay) AS n_arr_delay,
       CAST(sum(arr_delay) AS BIGINT) AS sum_arr_delay, count(cancelled) AS n_cancelled,
       CAST(sum(cancelled) AS BIGINT) AS sum_cancelled
FROM ontime GROUP BY year, quarter, month"""

_ROLLUP = _with("ontime") + """
SELECT year, quarter, count(*) AS n_flights,
       CAST(sum(arr_delay) AS DOUBLE) / count(arr_delay) AS avg_arr_delay,
       CAST(sum(cancelled) AS DOUBLE) / count(cancelled) AS cancel_rate
FROM ontime GROUP BY year, quarter"""

_MV_STATS = _with("ontime") + """
SELECT year, quarter,
       CAST(sum(arr_delay) AS DOUBLE) / count(arr_delay) AS avg_arr_delay,
       CAST(sum(cancelled) AS DOUBLE) / count(cancelled) AS cancel_rate
FROM ontime WHERE year = 1999 AND quarter = 3 GROUP BY year, quarter"""

_CURATED_MEDIA = """
SELECT CAST(page_id % 100 AS VARCHAR) AS product_id, url, count(*) AS n_files FROM pages GROUP BY ALL"""

_DOMAIN_COUNTS = """
SELECT 'product_master' AS domain, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_rejected FROM part
UNION ALL SELECT 'sales_transactions', count(*), 0 FROM orders
UNION ALL SELECT 'customer_reviews', count(*), 0 FROM documents
UNION ALL SELECT 'media_metadata', count(*), 0 FROM pages
UNION ALL SELECT 'returns_issues', count(*), 0 FROM lineitem WHERE l_returnflag = 'R'"""

_NEW_FILES = _with("raw_catalog") + """
SELECT relative_path, file_url, size, last_modified FROM raw_catalog
WHERE last_modified >= TIMESTAMP '2024-01-16 00:00:00' ORDER BY relative_path"""

_EXTRACT_SAMPLE = _with("processed") + """
SELECT relative_path,
       CAST(json_object('metadata', json(pdf_metadata), 'page_count', 1,
                        'chars', length(extracted_text), 'text', extracted_text) AS VARCHAR) AS parsed
FROM processed ORDER BY relative_path LIMIT 2"""

_GEO = """
SELECT entity_type, entity_id, name, lon, lat,
       'POINT(' || CAST(lon AS VARCHAR) || ' ' || CAST(lat AS VARCHAR) || ')' AS geo_point
FROM (
  SELECT 'supplier' AS entity_type, s_suppkey AS entity_id, s_name AS name,
         CAST(s_nationkey AS DOUBLE) * 10.0 - 120.0 AS lon, CAST(s_nationkey AS DOUBLE) * 3.0 - 36.0 AS lat
  FROM supplier
  UNION ALL
  SELECT 'customer', c_custkey, c_name,
         CAST(c_nationkey AS DOUBLE) * 10.0 - 120.0, CAST(c_nationkey AS DOUBLE) * 3.0 - 36.0
  FROM customer) t"""

_UNLOAD = _with("ontime") + """
SELECT year, quarter, month, count(*) AS n_rows, CAST(sum(arr_delay) AS BIGINT) AS sum_arr_delay,
       CAST(sum(cancelled) AS BIGINT) AS sum_cancelled
FROM ontime GROUP BY year, quarter, month"""


ORACLES: dict[str, str] = {
    "directory_listing": _with("stage_files") + "SELECT relative_path, file_url, size, last_modified FROM stage_files",
    "count_documents": _with("stage_files") + "SELECT count(*) AS pdfs FROM stage_files WHERE relative_path ILIKE '%.pdf'",
    "document_ids": _with("processed") + "SELECT pdf_id, split_part(pdf_id, '_', 1) AS product_id, file_name FROM processed",
    "payload_fields": "SELECT event_id, json_extract_string(props, '$.k') AS k_text, "
                      "CAST(length(props) AS INTEGER) AS props_chars FROM events",
    "try_page_count": "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DECIMAL(38,0)) AS k_number, "
                      "TRY_CAST(event_type AS DECIMAL(38,0)) AS type_number FROM events",
    "t1_register": _with("raw_catalog") + f"SELECT {RAW_COLS} FROM raw_catalog",
    "t1_replay": _with("raw_catalog") + f"SELECT {RAW_COLS} FROM raw_catalog",
    "t1_indexed": _with("raw_catalog") + f"SELECT {RAW_COLS} FROM raw_catalog",
    "new_files": _NEW_FILES,
    "t2_join_raw": _with("raw_catalog") + """
SELECT file_name, relative_path, file_url, last_modified FROM raw_catalog
WHERE last_modified >= TIMESTAMP '2024-01-16 00:00:00'""",
    "stage_listing_files": _with("stage_files") + "SELECT relative_path, size, last_modified FROM stage_files",
    "stage_walk_files": _with("stage_files") + "SELECT relative_path, size, last_modified FROM stage_files",
    "stage_walk_t1": _with("raw_catalog") + "SELECT file_name, relative_path, size, last_modified FROM raw_catalog",
    "stage_t1_t2": _with("processed") + """
SELECT pdf_id, file_name, relative_path, last_modified, pdf_metadata, page_count, extracted_text FROM processed""",
    "extract_documents": _with("processed") + f"SELECT {PROCESSED_COLS} FROM processed",
    "extract_sample": _EXTRACT_SAMPLE,
    "t2_incremental": _with("processed") + f"SELECT {PROCESSED_COLS} FROM processed",
    "t2_retry": _with("processed") + f"SELECT {PROCESSED_COLS} FROM processed",
    "t2_replay": _with("processed") + f"SELECT {PROCESSED_COLS} FROM processed",
    "deployment_reset": _with("raw_catalog", "processed") + """
SELECT split_part(p.pdf_id, '_', 1) AS product_id, count(*) AS n_files, CAST(sum(r.size) AS BIGINT) AS n_bytes,
       CAST(sum(p.page_count) AS BIGINT) AS n_pages
FROM raw_catalog r LEFT JOIN processed p ON r.relative_path = p.relative_path AND r.last_modified = p.last_modified
GROUP BY 1""",
    "row_counts": _with("raw_catalog", "processed") + """
SELECT 'raw' AS table_name, count(*) AS n_rows FROM raw_catalog
UNION ALL SELECT 'processed', count(*) FROM processed""",
    "pipeline_end_to_end": _final_sql("stats"),
    "media_by_product": _with("media_summary") + "SELECT * FROM media_summary",
    "curated_media": _CURATED_MEDIA,
    "returns_by_product": _with("returns_summary") + "SELECT * FROM returns_summary",
    "curated_feedback": _with("curated") + "SELECT * FROM curated",
    "geo_points": _GEO,
    "flatten_product_json": _FLATTEN,
    "load_raw_domains": _DOMAIN_COUNTS,
    "corrected_returns": """
SELECT CAST(l_partkey AS VARCHAR) AS product_id, count(*) AS return_count,
       sum(l_quantity + CASE WHEN l_orderkey // 4000 % 3 = 0 THEN 0 ELSE 1 END) AS return_qty
FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1""",
    "t2_waves": _with("raw_catalog") + """
SELECT wave, least(25, n - 25 * wave) AS n_files
FROM (SELECT n, unnest(range(0, (n + 24) // 25)) AS wave FROM (SELECT count(*) AS n FROM raw_catalog))""",
    "mv_refresh_loads": _MONTHLY,
    "reload_domains": _with("curated") + "SELECT * FROM curated",
    "layered_curation": _with("curated") + "SELECT * FROM curated",
    "stats_part": _with("stats") + "SELECT * FROM stats",
    "stats_nopart": _with("stats") + "SELECT * FROM stats",
    "stats_part_csv": _with("stats") + "SELECT * FROM stats",
    "stats_nopart_csv": _with("stats") + "SELECT * FROM stats",
    "mv_ontime_monthly": _MONTHLY,
    "mv_rollup_quarter": _ROLLUP,
    "mv_stats": _MV_STATS,
    "unload_partitioned": _UNLOAD,
    "final_integrated": _final_sql("stats"),
    "final_nopart": _final_sql("stats"),
    "final_filtered": _final_sql("stats", "WHERE review_year IN (1998, 1999)", "ORDER BY review_date DESC"),
    "final_empty_stats": _final_sql("stats_empty"),
    "final_count": _with("processed", "curated") + """
SELECT count(*) AS rows_cnt FROM processed p LEFT JOIN curated c ON c.product_id = split_part(p.pdf_id, '_', 1)""",
}
