"""SQL twins of the registered queries, written for DuckDB on the same tables.

Each one states the expected result independently of the Spark code: plain windows
over whole groups, recursive chunking, correlated lookups.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# -- inputs ----------------------------------------------------------------

EPOCH = "TIMESTAMP '2024-01-01 00:00:00'"
SHA = "sha256({})"
# form-style encoding and decoding on top of percent-style functions
ENC = "replace(replace(replace(url_encode({0}), '%20', '+'), '%2A', '*'), '~', '%7E')"
DEC = "url_decode(replace({0}, '+', ' '))"
LAST = "regexp_extract({0}, '[^/]*$')"
BLANK = "({0} IS NULL OR regexp_matches({0}, '\\A[\\x00-\\x20]*\\z'))"
BLANK_UNICODE = (
    "({0} IS NULL OR regexp_matches({0}, "
    "'\\A[\\x09-\\x0d\\x1c-\\x20\\x{{1680}}\\x{{2000}}-\\x{{2006}}\\x{{2008}}-\\x{{200a}}"
    "\\x{{2028}}\\x{{2029}}\\x{{205f}}\\x{{3000}}]*\\z'))"
)
EXT = (
    "CASE WHEN kind = 'blank' THEN '.txt' WHEN kind = 'pdf' THEN '.pdf' WHEN kind = 'plus' THEN '+x y.txt' "
    "WHEN doc_id % 6 = 0 THEN '.txt' WHEN doc_id % 6 = 1 THEN '.html' WHEN doc_id % 6 = 2 THEN '.md' "
    "WHEN doc_id % 6 = 3 THEN '.csv' WHEN doc_id % 6 = 4 THEN '.json' ELSE '' END"
)
MIME = (
    "CASE WHEN kind IN ('blank', 'plus') THEN 'text/plain' WHEN kind = 'pdf' THEN 'application/pdf' WHEN doc_id % 6 = 0 THEN 'text/plain' "
    "WHEN doc_id % 6 = 1 THEN 'text/html' WHEN doc_id % 6 = 2 THEN 'text/markdown' WHEN doc_id % 6 = 3 THEN 'text/csv' "
    "WHEN doc_id % 6 = 4 THEN 'application/json' END"
)
SERVICE = "CASE user_id % 3 WHEN 0 THEN 'watcher' WHEN 1 THEN 'extractor' ELSE 'embedder' END"

RAW_FILES = f"""raw_base AS (
  SELECT doc_id, source, NULL AS kind, text AS body FROM documents
  UNION ALL SELECT doc_id + 1000000000, source, 'blank', ' ' || chr(10) || chr(9) || ' ' FROM documents WHERE doc_id % 37 = 0
  UNION ALL SELECT doc_id + 2000000000, source, 'pdf', text FROM documents WHERE doc_id % 6 = 2
  UNION ALL SELECT doc_id + 3000000000, source, 'plus', text FROM documents WHERE doc_id % 31 = 0),
raw_files AS (
  SELECT doc_id, source, 'doc_' || doc_id || {EXT} AS filename,
         '/corpus/' || source || '/doc_' || doc_id || {EXT} AS path,
         {EPOCH} + to_minutes(doc_id) AS mtime,
         {MIME} AS by_name, body
  FROM raw_base)"""

STORE_REFS = f"""store_once AS (
  SELECT doc_id AS msg_id, {EPOCH} + to_seconds(doc_id) AS arrived_at, doc_id,
         CASE WHEN doc_id % 29 = 0 THEN 'S3' ELSE 'HDFS' END AS type,
         'http://namenode:9870/webhdfs/v1/corpus/' || source || '/' ||
         CASE WHEN doc_id % 23 = 0 THEN 'missing_' || doc_id ELSE 'doc_' || doc_id || replace({EXT}, ' ', '%20') END AS url
  FROM raw_base),
store_refs AS (
  SELECT * FROM store_once
  UNION ALL SELECT msg_id + 1000000000000, arrived_at + INTERVAL 1000 DAY, doc_id, type, url FROM store_once WHERE msg_id % 3 = 0)"""

FILE_REFS = f"""refs_once AS (
  SELECT page_id AS msg_id, {EPOCH} + to_seconds(page_id) AS arrived_at, page_id,
         page_id % 41 = 0 AS malformed,
         CASE WHEN page_id % 41 = 0 THEN NULL WHEN page_id % 17 = 0 THEN 'S3' WHEN page_id % 5 = 0 THEN 'hdfs' ELSE 'HDFS' END AS type,
         CASE WHEN page_id % 41 = 0 THEN NULL WHEN page_id % 19 = 0 THEN '' ELSE url END AS url,
         CASE WHEN page_id % 41 = 0 OR page_id % 4 = 0 THEN NULL ELSE 'in-' || (page_id % 3) END AS input_stream,
         CASE WHEN page_id % 41 = 0 THEN NULL ELSE 'out' END AS output_stream
  FROM pages),
parsed AS (
  SELECT * FROM refs_once
  UNION ALL SELECT msg_id + 1000000000000, arrived_at + INTERVAL 1000 DAY, page_id, malformed, type, url, input_stream, output_stream
  FROM refs_once WHERE msg_id % 3 = 0),
refs AS (
  SELECT *, {DEC.format(LAST.format('url'))} AS filename,
         CASE WHEN malformed THEN 'MALFORMED_JSON' WHEN upper(coalesce(type, '')) <> 'HDFS' THEN 'UNSUPPORTED_TYPE'
              WHEN trim(coalesce(url, '')) = '' THEN 'MISSING_URL'
              WHEN {LAST.format('url')} = '' THEN 'BAD_NAME' END AS reject
  FROM parsed)"""

STORE_URLS = """store_urls AS (
  SELECT page_id, CASE WHEN page_id % 2 = 0 THEN regexp_replace(url, '^(https?://[^/]+)/', '\\1/webhdfs/v1/in/') ELSE url END AS url
  FROM pages)"""

LEDGER = f"""ledger AS (
  SELECT doc_id AS seq, 'doc_' || (doc_id % 700) || '.txt' AS filename,
         'http://namenode:9870/webhdfs/v1/corpus/' || source || '/doc_' || (doc_id % 700) || '.txt' AS url,
         'text/plain' AS file_type, n_chars AS file_size, 1 AS chunk_count,
         {EPOCH} + to_minutes(doc_id) AS processed_at,
         CASE WHEN doc_id % 11 = 0 THEN 'ERROR' ELSE 'COMPLETED' END AS status,
         CASE WHEN doc_id % 7 = 0 THEN 'in-' || (doc_id % 3) END AS input_stream,
         CASE WHEN doc_id % 9 = 0 THEN 'out-' || (doc_id % 2) END AS output_stream,
         n_chars AS text_length, n_chars % 997 + 10 AS elapsed_ms
  FROM documents),
latest AS (SELECT * FROM ledger QUALIFY row_number() OVER (PARTITION BY filename ORDER BY processed_at DESC, seq DESC) = 1)"""

METRICS = f"""metrics AS (
  SELECT event_id, ts, user_id, {SERVICE} AS service, {SERVICE} || '-' || user_id AS "instanceId",
         CASE event_type WHEN 'signup' THEN 'INIT' WHEN 'view' THEN 'HEARTBEAT' WHEN 'click' THEN 'FILE_START'
              WHEN 'purchase' THEN 'FILE_COMPLETE' WHEN 'error' THEN 'ERROR' END AS event,
         CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type IN ('click', 'purchase') THEN 'PROCESSING'
              WHEN event_type = 'signup' THEN 'STARTING' WHEN event_id % 2 = 0 THEN 'RUNNING' ELSE 'IDLE' END AS status,
         CASE WHEN event_id % 3 = 0 THEN -1 ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS "pendingMessages",
         CASE WHEN event_type IN ('click', 'purchase') THEN 'doc_' || event_id || '.txt' END AS filename,
         CASE WHEN event_type = 'error' THEN 'failure ' || (event_id % 7) END AS "lastError",
         CASE WHEN user_id % 10 = 3 THEN '' ELSE 'host-' || (user_id % 10) END AS hostname,
         CASE WHEN user_id % 4 = 1 THEN 'pub-' || user_id || '.example.org:9000'
              WHEN user_id % 4 > 1 THEN 'pub-' || user_id || '.example.org' END AS "publicHostname",
         CASE WHEN event_id % 5 = 1 THEN '' WHEN event_id % 5 > 1 THEN 'http://app-' || user_id || '.example.org' END AS url,
         '5.' || (user_id % 4) || '.' || (event_id % 3) AS version,
         CASE WHEN event_id % 2 = 0 THEN 'state=running' ELSE 'state=stopped' END AS binding,
         user_id % 5 <> 0 AS dir_exists, 'z' || (user_id % 3) AS zone, value AS rate,
         CASE event_type WHEN 'signup' THEN 'starting' WHEN 'view' THEN 'idle' WHEN 'error' THEN 'error' ELSE 'processing' END AS stage
  FROM events)"""

BOOTS = """boots AS (
  SELECT *, max(CASE WHEN event = 'INIT' THEN (epoch_us(ts) // 1000) END)
            OVER (PARTITION BY service, "instanceId" ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS boot
  FROM metrics)"""

CONTROL = f"""control_log AS (
  SELECT event_id AS cmd_id, {SERVICE} || '-' || user_id AS instance_id, ts,
         CASE event_type WHEN 'signup' THEN 'start' WHEN 'error' THEN 'stop' WHEN 'purchase' THEN 'reset'
              WHEN 'click' THEN 'toggle' ELSE 'state' END AS cmd
  FROM events),
seg AS (
  SELECT *, count(*) FILTER (cmd IN ('start', 'stop', 'reset')) OVER w AS seg
  FROM control_log WINDOW w AS (PARTITION BY instance_id ORDER BY ts, cmd_id ROWS UNBOUNDED PRECEDING)),
stated AS (
  SELECT cmd_id, instance_id, ts, cmd,
         CAST((coalesce(max(CASE cmd WHEN 'start' THEN 1 WHEN 'stop' THEN 0 WHEN 'reset' THEN 0 END) OVER g, 0)
               + count(*) FILTER (cmd = 'toggle') OVER r) % 2 AS INTEGER) AS state_after
  FROM seg WINDOW g AS (PARTITION BY instance_id, seg),
                  r AS (PARTITION BY instance_id, seg ORDER BY ts, cmd_id ROWS UNBOUNDED PRECEDING)),
replay AS (
  SELECT cmd_id, instance_id, ts, cmd,
         CAST(coalesce(lag(state_after) OVER (PARTITION BY instance_id ORDER BY ts, cmd_id), 0) AS INTEGER) AS state_before, state_after,
         state_before <> state_after AS changed, state_before <> state_after OR cmd = 'reset' AS reported_change,
         CASE state_after WHEN 1 THEN 'STARTED' ELSE 'STOPPED' END AS status
  FROM stated),
control_state AS (
  SELECT instance_id, arg_max(status, (ts, cmd_id)) AS status,
         arg_max(ts, (ts, cmd_id)) FILTER (changed) AS last_changed,
         coalesce(arg_max(CASE state_after WHEN 1 THEN 'Processing started via API' ELSE 'Processing stopped via API' END, (ts, cmd_id))
                  FILTER (changed), 'Application startup') AS reason,
         arg_max(status, (ts, cmd_id)) = 'STARTED' AS enabled
  FROM replay GROUP BY instance_id)"""

BACKLOG = """arrivals AS (SELECT instance_id, ts, cmd_id AS event_id FROM control_log WHERE cmd = 'state'),
backlog AS (
  SELECT a.instance_id, a.event_id, a.ts AS arrived_at,
         CASE WHEN r.state_after = 1 THEN a.ts ELSE n.next_start END AS consumed_at, r.state_after = 0 AS waited
  FROM arrivals a JOIN replay r ON r.cmd_id = a.event_id
  JOIN (SELECT cmd_id, min(CASE WHEN changed AND state_after = 1 THEN ts END)
               OVER (PARTITION BY instance_id ORDER BY ts, cmd_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_start
        FROM replay) n ON n.cmd_id = a.event_id)"""


def html_sql(col: str) -> str:
    sql = (
        f"regexp_replace({col}, '<!--.*?(?:-->|\\z)|<head\\b[^>]*>.*?</head\\s*>|<script\\b[^>]*>.*?(?:</script\\s*>|\\z)"
        "|<style\\b[^>]*>.*?(?:</style\\s*>|\\z)', '', 'gis')"
    )
    sql = (
        f"regexp_replace({sql}, '</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|header|hr|html"
        "|li|main|nav|ol|p|pre|section|table|tbody|td|th|thead|tr|ul)\\b[^>]*>', chr(10), 'gi')"
    )
    sql = f"regexp_replace({sql}, '<[a-zA-Z/!?][^>]*(?:>|\\z)', '', 'g')"
    for entity, char in (
        ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "''"), ("&#39;", "''"), ("&copy;", "©"),
        ("&reg;", "®"), ("&middot;", "·"), ("&hellip;", "…"), ("&ndash;", "–"), ("&mdash;", "—"), ("&amp;", "&"),
    ):
        sql = f"replace({sql}, '{entity}', '{char}')"
    sql = f"regexp_replace({sql}, '[ \\t\\r\\f\\x0b]+', ' ', 'g')"
    sql = f"regexp_replace({sql}, ' ?\\n[ \\n]*', chr(10), 'g')"
    return f"regexp_replace({sql}, '\\A[\\s\\x0b]+|[\\s\\x0b]+\\z', '', 'g')"


def utf16_sql(text: str) -> str:
    # one unit more for every character outside the basic plane
    return f"CAST(length({text}) + length(regexp_replace({text}, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')) AS BIGINT)"


def output_path_sql(url: str, name: str) -> str:
    return f"{base_sql(url)} || '/processed_files/' || {ENC.format(name)} || '.txt'"


def base_sql(url: str) -> str:
    return (
        f"CASE WHEN contains({url}, '/webhdfs/v1/') THEN left({url}, CAST(strpos({url}, '/webhdfs/v1/') AS BIGINT) + 10) ELSE {url} END"
    )


def chunks_sql(budget: str, min_chars: str, min_len: str, cap: str, source: str) -> str:
    """Window by window from the start of the text; ``source`` yields doc_id, text and parameters."""
    trim = "regexp_replace({0}, '\\A[\\x00-\\x20]+|[\\x00-\\x20]+\\z', '', 'g')"
    return f"""src AS MATERIALIZED ({source}),
win AS (
  SELECT doc_id, 0 AS i, CAST(1 AS BIGINT) AS pos, CAST('' AS VARCHAR) AS w FROM src
  UNION ALL
  SELECT doc_id, i + 1, pos + length(nw), nw FROM (
    SELECT s.doc_id, win.i, win.pos + 0 AS pos,
           CASE WHEN {BLANK.format('s.cut')} THEN s.cut
                WHEN s.stop > s.min_chars + 1 THEN left(s.cut, s.stop) ELSE s.cut END AS nw
    FROM win, LATERAL (
      SELECT src.doc_id, src.min_chars, substring(src.text, win.pos, src.budget) AS cut,
             length(regexp_extract(substring(src.text, win.pos, src.budget), '(?s)\\A.*[.?!\\n]')) AS stop
      FROM src WHERE src.doc_id = win.doc_id AND win.pos <= length(src.text)) s)),
filled AS (
  SELECT w.doc_id, w.i, w.w, row_number() OVER (PARTITION BY w.doc_id ORDER BY w.i) AS k
  FROM win w WHERE w.i > 0 AND NOT {BLANK.format('w.w')}),
last AS (SELECT f.doc_id, f.i FROM filled f JOIN src USING (doc_id) WHERE f.k = src.max_chunks
         AND EXISTS (SELECT 1 FROM filled g WHERE g.doc_id = f.doc_id AND g.k > src.max_chunks)),
pieces AS (
  SELECT f.doc_id, f.k, {trim.format('f.w')} AS text, false AS overflow FROM filled f JOIN src USING (doc_id) WHERE f.k <= src.max_chunks
  UNION ALL
  SELECT w.doc_id, 1000000 AS k, {trim.format("replace(string_agg(w.w, '' ORDER BY w.i), chr(10), ' ')")}, true
  FROM win w JOIN last l ON l.doc_id = w.doc_id AND w.i > l.i GROUP BY w.doc_id),
chunks AS (
  SELECT p.doc_id, 1 AS page_no, CAST(row_number() OVER (PARTITION BY p.doc_id ORDER BY p.k) AS INTEGER) AS chunk_no,
         CAST(count(*) OVER (PARTITION BY p.doc_id) AS INTEGER) AS n_chunks, p.text, p.overflow
  FROM pieces p JOIN src USING (doc_id) WHERE length(p.text) > src.min_len)"""


DOC_CHUNKS = "WITH RECURSIVE " + chunks_sql(
    "budget", "min_chars", "min_len", "max_chunks",
    "SELECT doc_id, text, 2000 AS budget, 200 AS min_chars, 0 AS min_len, 1000000000 AS max_chunks FROM documents",
)

# -- sources ---------------------------------------------------------------

ORACLES["scan_binary"] = f"""SELECT 'doc+' || doc_id || '.txt' AS filename, CAST(strlen(coalesce(text, '')) AS BIGINT) AS length,
       {SHA.format("coalesce(text, '')")} AS content_sha FROM documents"""

ORACLES["fetch_files"] = f"""SELECT doc_id AS msg_id, true AS fetched, CAST(strlen(coalesce(text, '')) AS BIGINT) AS length,
       {SHA.format("coalesce(text, '')")} AS content_sha, NULL AS fetch_error FROM documents
UNION ALL SELECT doc_id + 1000000000, false, NULL, NULL, 'NOT_FOUND' FROM documents WHERE doc_id % 23 = 0"""

ORACLES["parse_file_refs"] = f"""WITH {FILE_REFS}
SELECT msg_id, arrived_at, type, url, input_stream AS "inputStream", output_stream AS "outputStream", malformed FROM parsed"""

ORACLES["fetch_by_ref"] = f"""WITH {RAW_FILES}, {STORE_REFS}
SELECT r.msg_id, r.url, 'out' AS "outputStream", f.path IS NOT NULL AS fetched, CAST(strlen(f.body) AS BIGINT) AS length, {SHA.format('f.body')} AS content_sha
FROM (SELECT * FROM store_refs WHERE type = 'HDFS' QUALIFY row_number() OVER (PARTITION BY url ORDER BY arrived_at, msg_id) = 1) r
LEFT JOIN raw_files f ON 'http://namenode:9870/webhdfs/v1' || replace(f.path, ' ', '%20') = r.url"""

ORACLES["queue_depth_parse"] = """WITH q AS (
  SELECT event_id, event_id % 8 AS shape, CAST(event_id % 500 AS INTEGER) AS n FROM events)
SELECT event_id, CASE WHEN shape IN (0, 1, 2) THEN n ELSE -1 END AS queue_depth,
       CASE WHEN shape IN (0, 1, 2) THEN 'ok' WHEN shape = 7 THEN 'unavailable' ELSE 'error' END AS status FROM q"""

# -- references ------------------------------------------------------------

ORACLES["validate_refs"] = f"WITH {FILE_REFS} SELECT msg_id, url, filename, reject FROM refs"

ORACLES["dedupe_refs"] = f"""WITH {FILE_REFS}, old AS (SELECT url FROM pages WHERE page_id % 10 = 0)
SELECT msg_id, {SHA.format('url')} AS url_key,
       CASE WHEN reject IS NOT NULL THEN 'REJECTED'
            WHEN url IN (SELECT url FROM old) THEN 'DUPLICATE'
            WHEN row_number() OVER (PARTITION BY reject IS NULL, url ORDER BY arrived_at, msg_id) = 1 THEN 'FIRST'
            ELSE 'DUPLICATE' END AS dedupe
FROM refs"""

ORACLES["dedupe_indexed"] = ORACLES["dedupe_refs"]

ORACLES["reprocess"] = f"""WITH {LEDGER},
chosen AS (SELECT DISTINCT 'http://namenode:9870/webhdfs/v1/corpus/' || source || '/doc_' || (doc_id % 700) || '.txt' AS url
           FROM documents WHERE doc_id % 5 = 0)
SELECT DISTINCT {SHA.format('url')} AS url_key, url NOT IN (SELECT url FROM chosen) AS still_done FROM ledger WHERE status = 'COMPLETED'"""

ORACLES["url_filename"] = f"SELECT page_id, {DEC.format(LAST.format('url'))} AS filename, {SHA.format('url')} AS url_key FROM pages"

ORACLES["fetch_url"] = f"""WITH {STORE_URLS},
o AS (SELECT page_id, CASE WHEN contains(url, 'op=OPEN') THEN url WHEN contains(url, '?') THEN url || '&op=OPEN' ELSE url || '?op=OPEN' END AS open_url
      FROM store_urls),
n AS (SELECT *, regexp_extract(open_url, '([^/?]*)(\\?[^/]*)?$', 1) AS name FROM o)
SELECT page_id, open_url, name,
       regexp_extract(open_url, '^(.*/)[^/]*$', 1) || CASE WHEN contains(name, '%') THEN name ELSE {ENC.format('name')} END
       || regexp_extract(open_url, '(\\?[^/]*)$', 1) AS fetch_url
FROM n"""

ORACLES["output_path"] = f"""WITH {STORE_URLS}, f AS (SELECT page_id, url, {DEC.format(LAST.format('url'))} AS filename FROM store_urls)
SELECT page_id, {base_sql('url')} AS base, {output_path_sql('url', 'filename')} AS output_path,
       '/data/output/' || filename || '.txt' AS local_path FROM f"""

ORACLES["path_collisions"] = f"""WITH {STORE_URLS},
f AS (SELECT url, 'http://nn/webhdfs/v1/processed_files/' || {ENC.format(DEC.format(LAST.format('url')))} || '.txt' AS output_path FROM store_urls)
SELECT output_path, count(DISTINCT url) AS n_urls, min(url) AS first_url, max(url) AS last_url FROM f GROUP BY output_path HAVING count(DISTINCT url) > 1"""

# -- extraction ------------------------------------------------------------

ORACLES["extract_html"] = f"""WITH t AS (SELECT page_id, url, {DEC.format(LAST.format('url'))} AS filename, chr(10) || chr(10) || {html_sql('html')} AS text FROM pages)
SELECT page_id, filename, {output_path_sql('url', 'filename')} AS output_path, text, {utf16_sql('text')} AS n_utf16
FROM t WHERE NOT {BLANK.format('text')}"""

TEXTS = f"""texts AS (
  SELECT *, coalesce(by_name, CASE WHEN regexp_matches(body, '(?i)\\A\\s*<(!doctype|html)\\b') THEN 'text/html' ELSE 'text/plain' END) AS mime,
         CASE WHEN by_name = 'application/pdf' THEN 'UNSUPPORTED_FORMAT' END AS failure,
         CASE WHEN by_name = 'application/pdf' THEN '' WHEN by_name = 'text/html' THEN chr(10) || chr(10) || {html_sql('body')}
              ELSE chr(10) || chr(10) || body END AS text
  FROM raw_files)"""

ORACLES["extract_text"] = f"""WITH {RAW_FILES}, {TEXTS}
SELECT doc_id, mime, failure, text, CAST(length(text) AS INTEGER) AS n_chars FROM texts"""

ORACLES["content_type"] = f"WITH {RAW_FILES}, {TEXTS} SELECT doc_id, by_name, mime FROM texts"

ORACLES["size_class"] = f"""WITH {RAW_FILES}
SELECT CASE WHEN strlen(body) > 8192 THEN 'LARGE' ELSE 'NORMAL' END AS size_class, count(*) AS n,
       CAST(sum(strlen(body)) AS BIGINT) AS bytes, CAST(max(strlen(body)) AS BIGINT) AS largest FROM raw_files GROUP BY 1"""

ORACLES["classify_text"] = f"""WITH b AS (
  SELECT doc_id, text AS body FROM documents
  UNION ALL SELECT doc_id + 1000000000, CASE doc_id % 7 WHEN 0 THEN '' WHEN 1 THEN ' ' || chr(10) || chr(9) WHEN 2 THEN chr(8195) WHEN 3 THEN chr(160)
                      WHEN 4 THEN chr(1) WHEN 5 THEN 'x' WHEN 6 THEN NULL END FROM documents)
SELECT doc_id, {BLANK.format('body')} AS blank_trimmed, {BLANK_UNICODE.format('body')} AS blank_unicode FROM b"""

ORACLES["join_pages"] = """SELECT doc_id, chr(10) || chr(10) || replace(text, chr(10), chr(10) || chr(10)) AS text,
       replace(text, chr(10), chr(10) || chr(10)) AS plain FROM documents"""

ORACLES["page_diag"] = """WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents)
SELECT doc_id, CAST(n - 1 AS INTEGER) AS page_no, CAST(length(t) AS INTEGER) AS n_chars, left(t, 300) AS snippet_300, left(t, 150) AS snippet_150 FROM p"""

ORACLES["safe_name"] = f"""WITH f AS (SELECT page_id, regexp_replace({DEC.format(LAST.format('url'))}, '[^a-zA-Z0-9._-]', '_', 'g') AS safe FROM pages)
SELECT page_id, safe, safe || '_extracted.txt' AS text_dump, safe || '_chunked.txt' AS chunk_dump FROM f"""

# -- chunks ----------------------------------------------------------------

ORACLES["chunk_text"] = f"{DOC_CHUNKS} SELECT * FROM chunks"

ORACLES["chunk_split_file"] = f"""{DOC_CHUNKS}
SELECT doc_id, CAST(chunk_no AS BIGINT) AS chunk_no, CAST(n_chunks AS BIGINT) AS n_chunks, text FROM chunks"""

ORACLES["chunk_text_large"] = (
    "WITH RECURSIVE "
    + chunks_sql("budget", "min_chars", "min_len", "max_chunks", "SELECT doc_id, text, 4000 AS budget, 100 AS min_chars, 0 AS min_len, 1000000000 AS max_chunks FROM documents")
    + " SELECT * FROM chunks"
)

ORACLES["chunk_capped"] = (
    "WITH RECURSIVE "
    + chunks_sql("budget", "min_chars", "min_len", "max_chunks", "SELECT doc_id, text, 2000 AS budget, 200 AS min_chars, 40 AS min_len, 8 AS max_chunks FROM documents")
    + """ SELECT doc_id, CAST(count(*) FILTER (length(p.text) > 40) AS INTEGER) AS n_chunks,
       CAST(coalesce(sum(length(p.text)) FILTER (length(p.text) <= 40), 0) AS BIGINT) AS left_out
FROM documents d LEFT JOIN pieces p USING (doc_id) GROUP BY doc_id"""
)

ORACLES["chunk_loss"] = f"""SELECT doc_id, length(regexp_replace(text, '[\\x00-\\x20]', '', 'g')) AS n_in,
       length(regexp_replace(text, '[\\x00-\\x20]', '', 'g')) AS n_out, true AS within_budget
FROM documents WHERE NOT {BLANK.format('text')}"""

# a byte-pair encoder is not SQL; the chunks themselves are tested against the tokenizer
ORACLES["chunk_tokens_loss"] = r"""
SELECT doc_id, n_in, CASE WHEN n_in > 0 THEN n_in END AS n_out, CASE WHEN n_in > 0 THEN false END AS over_budget,
       CASE WHEN n_in > 0 THEN true END AS all_there
FROM (SELECT doc_id, length(regexp_replace(text, '[\x00-\x20]', '', 'g')) AS n_in FROM documents)"""

ORACLES["chunk_report"] = f"""{DOC_CHUNKS}
SELECT d.doc_id, coalesce(string_agg('=== CHUNK ' || chunk_no || ' OF ' || n_chunks || ' ===' || chr(10) || c.text || chr(10) || chr(10), '' ORDER BY chunk_no), '') AS report
FROM documents d LEFT JOIN chunks c USING (doc_id) GROUP BY d.doc_id"""

ORACLES["chunk_rejoin"] = f"{DOC_CHUNKS} SELECT doc_id, string_agg(text, '' ORDER BY chunk_no) AS text FROM chunks GROUP BY doc_id"

ORACLES["chunk_stats"] = f"""{DOC_CHUNKS}
SELECT doc_id, count(*) AS n_chunks, CAST(sum(length(text)) AS BIGINT) AS n_chars, CAST(max(length(text)) AS INTEGER) AS longest FROM chunks GROUP BY doc_id"""

ORACLES["chunk_params"] = """WITH p AS (
  SELECT doc_id, n_chars > 8192 AS large,
         CASE WHEN n_chars > 8192 THEN greatest(500, least(1000, n_chars * 16 // 8)) ELSE greatest(1000, least(2000, n_chars * 16 // 4)) END AS tokens
  FROM documents)
SELECT doc_id, CAST(tokens AS INTEGER) AS tokens, CAST(greatest(CASE WHEN large THEN 50 ELSE 100 END, tokens // 10) AS INTEGER) AS min_chars,
       CAST(greatest(CASE WHEN large THEN 10 ELSE 20 END, tokens // 50) AS INTEGER) AS min_len,
       CASE WHEN large THEN 500 ELSE 1000 END AS max_chunks FROM p"""

ORACLES["estimate_chunks"] = """SELECT doc_id, (n_chars * 1000 + 262143) // 262144 AS n_chunks,
       printf('%.2f', n_chars * 1000 / 1048576.0) AS mb FROM documents"""

# -- outcomes and ledger ---------------------------------------------------

ORACLES["route_outcome"] = f"""WITH {RAW_FILES}, {STORE_REFS}, {TEXTS},
first AS (
  SELECT r.*, f.mime, f.body IS NOT NULL AS fetched, f.failure, f.text
  FROM (SELECT * FROM store_refs WHERE type = 'HDFS' QUALIFY row_number() OVER (PARTITION BY url ORDER BY arrived_at, msg_id) = 1) r
  LEFT JOIN texts f ON 'http://namenode:9870/webhdfs/v1' || replace(f.path, ' ', '%20') = r.url),
settled AS (
  SELECT *, CASE WHEN NOT fetched THEN 'NOT_FOUND' WHEN failure IS NOT NULL THEN failure
                 WHEN {BLANK.format('text')} THEN 'BLANK' ELSE 'COMPLETED' END AS outcome FROM first),
o AS (
  SELECT r.msg_id, CASE WHEN r.type <> 'HDFS' THEN 'REJECTED' WHEN s.msg_id = r.msg_id THEN 'FIRST' ELSE 'DUPLICATE' END AS dedupe,
         CASE WHEN r.type <> 'HDFS' THEN 'UNSUPPORTED_TYPE' WHEN s.msg_id = r.msg_id OR s.outcome <> 'COMPLETED' THEN s.outcome ELSE 'DUPLICATE' END AS outcome,
         CASE WHEN s.msg_id = r.msg_id THEN s.mime END AS mime,
         CASE WHEN s.msg_id = r.msg_id AND s.outcome = 'COMPLETED' THEN {utf16_sql('s.text')} END AS text_length
  FROM store_refs r LEFT JOIN settled s ON s.url = r.url AND r.type = 'HDFS')
SELECT msg_id, dedupe, outcome, CASE outcome WHEN 'COMPLETED' THEN 'processed' WHEN 'DUPLICATE' THEN 'skipped' ELSE 'error' END AS destination, mime, text_length FROM o"""

ORACLES["stream_extract"] = f"SELECT msg_id, dedupe, outcome, mime, text_length FROM ({ORACLES['route_outcome']})"

CHUNK_SOURCE = f"""SELECT r.msg_id AS doc_id, CASE WHEN t.mime = 'text/html' THEN {html_sql('t.body')} ELSE t.body END AS text,
  2000 AS budget, 200 AS min_chars, 0 AS min_len, 1000000000 AS max_chunks
FROM (SELECT * FROM store_refs WHERE type = 'HDFS' QUALIFY row_number() OVER (PARTITION BY url ORDER BY arrived_at, msg_id) = 1) r
JOIN texts t ON 'http://namenode:9870/webhdfs/v1' || replace(t.path, ' ', '%20') = r.url WHERE t.failure IS NULL"""
ORACLES["chunk_refs"] = (
    f"WITH RECURSIVE {RAW_FILES}, {STORE_REFS}, {TEXTS}, "
    + chunks_sql("budget", "min_chars", "min_len", "max_chunks", CHUNK_SOURCE)
    + " SELECT doc_id AS msg_id, chunk_no, n_chunks, text, overflow FROM chunks"
)

ORACLES["directory_batch"] = f"""WITH {RAW_FILES}, {TEXTS},
o AS (SELECT *, CASE WHEN failure IS NOT NULL THEN failure WHEN {BLANK_UNICODE.format('text')} THEN 'BLANK' ELSE 'COMPLETED' END AS outcome
      FROM texts WHERE doc_id % 4 <> 0)
SELECT filename, mime, outcome, CASE outcome WHEN 'COMPLETED' THEN 'processed' ELSE 'error' END AS destination,
       CASE WHEN outcome = 'COMPLETED' THEN {utf16_sql('text')} END AS text_length FROM o"""

ORACLES["processed_message"] = f"""WITH {FILE_REFS}, o AS (
  SELECT r.msg_id, r.url, input_stream, {output_path_sql('r.url', 'filename')} AS target, {html_sql('p.html')} AS text
  FROM refs r JOIN pages p USING (page_id) WHERE reject IS NULL)
SELECT msg_id, '{{"type":"HDFS","url":"' || target || '"' || coalesce(',"inputStream":"' || input_stream || '"', '')
       || ',"outputStream":"out","processed":true,"originalFile":"' || url || '"}}' AS message,
       url AS header_original_file, target AS header_processed_url, {utf16_sql('text')} AS header_text_length FROM o"""

ORACLES["ledger_project"] = f"""WITH {FILE_REFS}
SELECT filename, {SHA.format('url')} AS url_key, CASE WHEN regexp_matches(filename, '\\.html\\z') THEN 'text/html' END AS file_type,
       262144 AS chunk_size, 1 AS chunk_count, arrived_at AS processed_at, 'COMPLETED' AS status,
       coalesce(input_stream, 'default-input') AS input_stream, coalesce(output_stream, 'default-output') AS output_stream
FROM refs WHERE reject IS NULL"""

ERRORS = """errors AS (SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN 'NO_MESSAGE' ELSE
  CASE doc_id % 8 WHEN 0 THEN 'CORRUPTED_PDF' WHEN 1 THEN 'CORRUPTED_PDF' WHEN 2 THEN 'PARSE_ERROR' WHEN 3 THEN 'IO_ERROR'
                  WHEN 4 THEN 'MEMORY_ERROR' WHEN 5 THEN 'MEMORY_ERROR' WHEN 6 THEN 'UNKNOWN' ELSE 'PARSE_ERROR' END END AS error_class FROM documents)"""
ORACLES["error_class"] = f"WITH {ERRORS} SELECT doc_id, error_class FROM errors"
ORACLES["error_counts"] = f"WITH {ERRORS} SELECT error_class, count(*) AS n FROM errors GROUP BY 1"

ORACLES["ledger_latest"] = f"WITH {LEDGER} SELECT filename, seq, status, file_size, processed_at FROM latest"
ORACLES["processed_list"] = f"""WITH {LEDGER}
SELECT filename, file_type, file_size, chunk_count, processed_at, text_length, elapsed_ms FROM latest WHERE status = 'COMPLETED'"""
ORACLES["ledger_lookup"] = f"""WITH {LEDGER}
SELECT filename, seq, status FROM latest WHERE filename IN (SELECT 'doc_' || doc_id || '.txt' FROM labels)"""
ORACLES["ledger_stats"] = f"""WITH {LEDGER}
SELECT status, file_type, count(*) AS n_files, CAST(sum(file_size) AS BIGINT) AS bytes, CAST(sum(text_length) AS BIGINT) AS chars,
       max(text_length) AS max_chars, avg(text_length) AS avg_chars, CAST(sum(chunk_count) AS BIGINT) AS chunks, CAST(sum(elapsed_ms) AS BIGINT) AS elapsed_ms
FROM latest GROUP BY status, file_type"""
ORACLES["stream_names"] = f"""WITH {LEDGER}
SELECT coalesce(arg_max(input_stream, (processed_at, seq)) FILTER (input_stream IS NOT NULL), 'default-input') AS input_stream,
       coalesce(arg_max(output_stream, (processed_at, seq)) FILTER (output_stream IS NOT NULL), 'default-output') AS output_stream FROM ledger"""

ORACLES["pending_files"] = f"WITH {RAW_FILES} SELECT path, filename FROM raw_files WHERE doc_id % 4 = 0"
ORACLES["pending_report"] = f"""WITH {RAW_FILES}
SELECT 'standalone' AS mode, '/corpus/' || source AS directory, count(*) AS count FROM raw_files WHERE doc_id % 4 = 0 GROUP BY source"""
ORACLES["pending_queue"] = """WITH q AS (
  SELECT user_id, ts, event_id, CASE WHEN event_id % 8 < 3 THEN CAST(event_id % 500 AS INTEGER) ELSE -1 END AS depth FROM events)
SELECT user_id, arg_max(depth, (ts, event_id)) AS queue_depth FROM q GROUP BY user_id
UNION ALL SELECT -1, arg_max(depth, (ts, event_id)) FROM q"""
ORACLES["pending_estimate"] = f"""WITH {RAW_FILES}, {LEDGER}
SELECT count(*) AS pending_count,
       CAST(ceil(count(*) * (SELECT avg(elapsed_ms) FROM latest WHERE status = 'COMPLETED') / 1000.0) AS BIGINT) AS estimated_seconds,
       arg_min(path, (mtime, doc_id)) AS next_url FROM raw_files WHERE doc_id % 4 = 0"""

# -- monitoring ------------------------------------------------------------

ORACLES["metrics_parse"] = f"""WITH {METRICS}, p AS (SELECT *, event_id % 43 = 0 AS malformed FROM metrics)
SELECT event_id, CASE WHEN NOT malformed THEN "instanceId" END AS "instanceId",
       CASE WHEN NOT malformed AND event_id % 31 <> 0 THEN event END AS event,
       CASE WHEN NOT malformed THEN CASE WHEN event_id % 37 = 0 THEN 'BROKEN' ELSE status END END AS status,
       CASE WHEN NOT malformed THEN "pendingMessages" END AS "pendingMessages", CASE WHEN NOT malformed THEN rate END AS "processingRate",
       CASE WHEN NOT malformed THEN CASE WHEN event_id % 2 = 0 THEN ts ELSE date_trunc('millisecond', ts) END END AS ts,
       CASE WHEN NOT malformed THEN service END AS service, CASE WHEN NOT malformed THEN binding END AS "bindingState",
       CASE WHEN NOT malformed THEN zone END AS zone, malformed FROM p"""

ORACLES["validate_metrics"] = f"""WITH {METRICS}
SELECT event_id, CASE WHEN event_id % 43 = 0 THEN 'malformed' ELSE concat_ws(',', CASE WHEN event_id % 31 = 0 THEN 'missing:event' END,
       CASE WHEN event_id % 5 = 0 THEN 'missing:url' END, CASE WHEN event_id % 37 = 0 THEN 'value:status' END) END AS violations FROM metrics"""

ORACLES["event_search"] = f"""WITH {METRICS} SELECT event_id FROM metrics WHERE "lastError" = 'failure 3' AND event_id % 43 <> 0"""

ORACLES["metrics_json"] = f"""WITH {METRICS}
SELECT event_id, '{{"instanceId":"' || "instanceId" || '","timestamp":"'
  || CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' ELSE CAST((epoch_us(ts) // 1000) AS VARCHAR) END
  || '","event":"' || event || '","status":"' || status || '"' || coalesce(',"lastError":"' || "lastError" || '"', '')
  || ',"pendingMessages":' || "pendingMessages" || coalesce(',"url":"' || url || '"', '') || '}}' AS value FROM metrics"""

ORACLES["instance_registry"] = f"""WITH {METRICS}
SELECT service, "instanceId", max(ts) AS last_activity, max(ts) FILTER (event IN ('INIT', 'HEARTBEAT')) AS last_heartbeat,
       max(ts) FILTER (event = 'SHUTDOWN') AS last_shutdown, count(*) AS n_messages FROM metrics GROUP BY service, "instanceId\""""

LIVE = """reg AS (
  SELECT service, "instanceId", max(ts) AS act, max(ts) FILTER (event IN ('INIT', 'HEARTBEAT')) AS hb FROM metrics GROUP BY service, "instanceId"),
live AS (
  SELECT service, "instanceId", CASE WHEN n.now - act <= INTERVAL 6 HOUR THEN 'Alive' WHEN n.now - act <= INTERVAL 12 HOUR THEN 'Degraded' ELSE 'Offline' END AS liveness,
         coalesce(n.now - hb > INTERVAL 4 HOUR, true) AS hb_stale
  FROM reg, (SELECT max(ts) AS now FROM events) n)"""
ORACLES["liveness"] = f"WITH {METRICS}, {LIVE} SELECT * FROM live"
ORACLES["service_rollup"] = f"WITH {METRICS}, {LIVE} SELECT service, liveness, count(*) AS n_instances FROM live GROUP BY service, liveness"

ORACLES["dashboard_counts"] = f"""WITH {METRICS}
SELECT count(*) AS total, count(*) FILTER (status IN ('RUNNING', 'PROCESSING')) AS active, count(*) FILTER (status = 'ERROR') AS errors FROM metrics"""

ORACLES["recent_events"] = f"""WITH {METRICS}
SELECT event_id, ts, "instanceId", event, status FROM metrics ORDER BY ts DESC, event_id DESC LIMIT 50"""

ORACLES["instance_rates"] = f"""WITH {METRICS}, a AS (
  SELECT service, "instanceId", count(*) FILTER (event = 'FILE_COMPLETE') AS files_processed,
         (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000 AS uptime_s FROM metrics GROUP BY service, "instanceId")
SELECT service, "instanceId", files_processed, uptime_s, CASE WHEN uptime_s > 0 THEN CAST(files_processed AS DOUBLE) / CAST(uptime_s AS DOUBLE) ELSE 0.0::DOUBLE END AS rate,
       (uptime_s // 3600) || 'h ' || ((uptime_s // 60) % 60) || 'm' AS uptime FROM a"""

ORACLES["restarts"] = f"""WITH {METRICS}, {BOOTS}
SELECT service, "instanceId", count(DISTINCT boot) AS boots, greatest(count(DISTINCT boot) - 1, 0) AS restarts,
       arg_max(version, (ts, event_id)) AS version FROM boots GROUP BY service, "instanceId\""""

ORACLES["init_messages"] = f"""WITH {METRICS}, {BOOTS}
SELECT service, "instanceId", boot AS "bootEpoch", ts, version, hostname, 'INIT' AS event, 'STARTING' AS status, 'starting' AS stage, '0s' AS uptime,
       CAST(0 AS BIGINT) AS "filesProcessed", CAST(0 AS BIGINT) AS "errorCount", CAST(-1 AS BIGINT) AS "filesTotal", CAST(-1 AS BIGINT) AS "pendingMessages"
FROM boots WHERE boot IS NOT NULL QUALIFY row_number() OVER (PARTITION BY service, "instanceId", boot ORDER BY ts, event_id) = 1"""

ORACLES["uptime_format"] = f"""WITH s AS (SELECT event_id, epoch_us(ts - {EPOCH}) // 1000000 AS n FROM events)
SELECT event_id, (n // 3600) || 'h ' || ((n // 60) % 60) || 'm' AS uptime FROM s"""

ORACLES["event_status"] = f"""WITH {METRICS}
SELECT event_id, CASE WHEN event IN ('FILE_START', 'FILE_COMPLETE') THEN 'PROCESSING' WHEN event_id % 2 = 0 AND event_id % 3 <> 0 THEN 'RUNNING' ELSE 'IDLE' END AS status,
       CASE WHEN event IN ('FILE_START', 'FILE_COMPLETE') OR (event_id % 2 = 0 AND event_id % 3 <> 0) THEN 'processing' ELSE 'idle' END AS stage FROM metrics"""

ORACLES["consumer_status"] = """WITH r AS (
  SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN CASE event_id % 6 WHEN 0 THEN 'running' WHEN 1 THEN 'Binding x: STOPPED' WHEN 2 THEN 'running then stopped'
         WHEN 3 THEN 'foo' WHEN 4 THEN '[state=running, group=a]' ELSE '[state=stopped]' END END AS raw FROM events)
SELECT event_id, CASE WHEN raw IS NULL THEN 'UNKNOWN' WHEN lower(raw) LIKE '%running%' THEN 'CONSUMING' WHEN lower(raw) LIKE '%stopped%' THEN 'IDLE' ELSE upper(raw) END AS consumer_status,
       'Binding input-0: ' || CASE WHEN raw IS NULL THEN 'unknown' WHEN raw LIKE '%state=running%' THEN 'running' WHEN raw LIKE '%state=stopped%' THEN 'stopped' ELSE raw END AS binding_status,
       coalesce(raw LIKE '%running%', false) AS running FROM r"""

ORACLES["instance_url"] = f"""WITH {METRICS}, t AS (
  SELECT *, coalesce(nullif("publicHostname", ''), nullif(hostname, '')) AS target, CASE WHEN event_id % 3 = 0 THEN 9090 ELSE 8080 END AS port FROM metrics)
SELECT event_id, coalesce(nullif(url, ''), 'http://' || CASE WHEN regexp_matches(target, ':\\d+$') THEN target ELSE target || ':8080' END) AS instance_url, port,
       coalesce(nullif(url, ''), 'https://' || nullif("publicHostname", ''), 'http://localhost:' || port) AS public_url FROM t"""

ORACLES["instance_id"] = """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'fixed' WHEN event_id % 3 = 0 THEN 'app-' || user_id
       WHEN event_id % 4 <> 0 AND event_id > 0 THEN 'app-' || event_id || '@host-1' ELSE 'app-unknown@host-1' END AS instance_id FROM events"""

ORACLES["metrics_snapshot"] = f"""WITH {METRICS}, {CONTROL}, a AS (
  SELECT service, "instanceId", count(*) FILTER (event = 'FILE_COMPLETE') AS done, min(ts) AS t0, arg_max(hostname, (ts, event_id)) AS hostname,
         arg_max(version, (ts, event_id)) AS version, arg_max("pendingMessages", (ts, event_id)) FILTER ("pendingMessages" <> -1) AS pending
  FROM metrics GROUP BY service, "instanceId"),
s AS (SELECT a.*, (epoch_us((SELECT max(ts) FROM events)) - epoch_us(t0)) // 1000000 AS n, coalesce(c.enabled, false) AS enabled
      FROM a LEFT JOIN control_state c ON c.instance_id = a."instanceId")
SELECT service, "instanceId", 'HEARTBEAT' AS event, CASE WHEN enabled THEN 'RUNNING' ELSE 'IDLE' END AS status, CASE WHEN enabled THEN 'processing' ELSE 'idle' END AS stage,
       done AS "filesProcessed", pending AS "pendingMessages", CASE WHEN n > 0 THEN CAST(done AS DOUBLE) / CAST(n AS DOUBLE) ELSE 0.0::DOUBLE END AS "processingRate",
       (n // 3600) || 'h ' || ((n // 60) % 60) || 'm' AS uptime, hostname, version FROM s"""

ORACLES["health_report"] = f"""WITH {METRICS}, {CONTROL}, a AS (
  SELECT service, "instanceId", arg_max(dir_exists, (ts, event_id)) AS dir_exists, arg_max(binding, (ts, event_id)) AS binding,
         count(*) FILTER (event = 'FILE_COMPLETE') AS processed_count FROM metrics GROUP BY service, "instanceId")
SELECT service, "instanceId", CASE WHEN dir_exists THEN 'UP' ELSE 'DEGRADED' END AS health, coalesce(c.status, 'STOPPED') AS processing_state,
       binding = 'state=running' AS consumer_running, dir_exists, processed_count
FROM a LEFT JOIN control_state c ON c.instance_id = a."instanceId\""""

ORACLES["status_mapping"] = f"""WITH {METRICS}, w AS (
  SELECT *, max(CASE WHEN event IN ('FILE_START', 'FILE_COMPLETE') THEN ts END)
            OVER (PARTITION BY "instanceId" ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS work FROM metrics)
SELECT event_id, CASE WHEN status = 'ERROR' THEN 'ERROR' WHEN NOT dir_exists THEN 'DISABLED' WHEN ts - work <= INTERVAL 6 HOUR THEN 'PROCESSING' ELSE 'IDLE' END AS mapped_status FROM w"""

ORACLES["error_tracking"] = f"""WITH {METRICS}
SELECT event_id, count(*) FILTER (event = 'ERROR') OVER w AS "errorCount", last_value("lastError" IGNORE NULLS) OVER w AS "lastError"
FROM metrics WINDOW w AS (PARTITION BY "instanceId" ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

ORACLES["heartbeat_windows"] = f"""WITH {METRICS}
SELECT service, "instanceId", date_trunc('hour', ts) AS window_start, count(*) AS n_messages, count(*) FILTER (event IN ('INIT', 'HEARTBEAT')) AS n_heartbeats
FROM metrics GROUP BY ALL"""

ORACLES["missed_heartbeats"] = f"""WITH {METRICS}, b AS (
  SELECT "instanceId", event_id, ts, lag(ts) OVER (PARTITION BY "instanceId" ORDER BY ts, event_id) AS previous_ts
  FROM metrics WHERE event IN ('INIT', 'HEARTBEAT'))
SELECT *, (epoch_us(ts) - epoch_us(previous_ts) - 1) // 14400000000 AS missed FROM b WHERE (epoch_us(ts) - epoch_us(previous_ts) - 1) // 14400000000 > 0"""

# -- control log -----------------------------------------------------------

ORACLES["control_replay"] = f"WITH {CONTROL} SELECT * FROM replay"
ORACLES["control_state"] = f"WITH {CONTROL} SELECT * FROM control_state"
ORACLES["control_response"] = f"""WITH {CONTROL}
SELECT cmd_id, instance_id, ts, cmd, status, reported_change AS state_changed, CASE state_after WHEN 1 THEN 'CONSUMING' ELSE 'IDLE' END AS consumer_status,
       CASE WHEN cmd = 'toggle' THEN CASE state_after WHEN 1 THEN 'started' ELSE 'stopped' END END AS action,
       CASE cmd WHEN 'start' THEN 'Processing started successfully' WHEN 'stop' THEN 'Processing stopped successfully. Messages will remain in queue.'
            WHEN 'reset' THEN 'Reset completed successfully. Processing stopped and files cleared.'
            WHEN 'toggle' THEN CASE state_after WHEN 1
              THEN 'Processing started successfully. Previous state: disabled, Current state: enabled. Now consuming messages from queue.'
              ELSE 'Processing stopped successfully. Previous state: enabled, Current state: disabled. Messages will remain in queue.' END END AS message FROM replay"""
ORACLES["backlog_consume"] = f"WITH {CONTROL}, {BACKLOG} SELECT * FROM backlog"
ORACLES["queue_depth_series"] = f"""WITH {CONTROL}, {BACKLOG},
moves AS (SELECT instance_id, arrived_at AS ts, 1 AS a, 0 AS t FROM backlog
          UNION ALL SELECT instance_id, consumed_at, 0, 1 FROM backlog WHERE consumed_at IS NOT NULL),
steps AS (SELECT instance_id, ts, CAST(sum(a) AS BIGINT) AS arrived, CAST(sum(t) AS BIGINT) AS taken FROM moves GROUP BY instance_id, ts)
SELECT instance_id, ts, arrived, taken, CAST(sum(arrived - taken) OVER (PARTITION BY instance_id ORDER BY ts) AS BIGINT) AS depth FROM steps"""
