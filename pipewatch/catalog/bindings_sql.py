"""DuckDB texts of the bindings, for the oracle queries."""

from __future__ import annotations

from pipewatch.catalog import bindings as b


def quote(value: str | None) -> str:
    if value is None:
        return "NULL"
    parts = value.replace("'", "''").split("\n")
    return "(" + " || chr(10) || ".join(f"'{p}'" for p in parts) + ")"


def pick(values, index: str) -> str:
    arms = " ".join(f"WHEN {i} THEN {quote(v)}" for i, v in enumerate(values))
    return f"CASE {index} {arms} END"


DAY, HOUR = 86400000000, 3600000000

EVENT_RUNS = """event_runs AS (
 SELECT CAST(user_id AS VARCHAR) AS dag_id, CAST(event_id AS VARCHAR) AS run_id,
  epoch_us(ts) AS at_us, ts AS logical_date,
  CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'running' ELSE 'success' END AS state,
  CAST(round(value * 1000000) AS BIGINT) AS dur
 FROM events)"""

ORDER_RUNS = """order_runs AS (
 SELECT CAST(o_custkey % 50 AS VARCHAR) AS dag_id, CAST(o_orderkey AS VARCHAR) AS run_id,
  epoch_us(o_orderdate) AS at_us, o_orderdate AS logical_date,
  CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'success' ELSE 'running' END AS state,
  CASE WHEN o_orderkey % 13 <> 0 THEN CAST(round(o_totalprice) AS BIGINT) * 1000000 END AS dur,
  lower(o_orderpriority) AS run_type, o_orderkey % 5 = 0 AS external_trigger,
  CAST(o_orderkey % 3 AS INTEGER) AS clear_number
 FROM orders)"""

ORDER_TASKS = f"""order_tasks AS (
 SELECT CAST(o_custkey % 50 AS VARCHAR) AS dag_id, CAST(l_orderkey AS VARCHAR) AS run_id,
  CAST(l_linenumber AS VARCHAR) AS task_id, epoch_us(o_orderdate) AS run_at,
  CASE l_returnflag WHEN 'R' THEN 'failed' WHEN 'A' THEN 'success' ELSE 'skipped' END AS state,
  CASE WHEN l_suppkey % 13 <> 0 THEN l_linenumber END AS try_number,
  CASE WHEN l_suppkey % 17 <> 0 THEN epoch_us(o_orderdate) + (l_partkey % 120 - 40) * {DAY} END AS s_at,
  CASE WHEN l_partkey % 11 <> 0 THEN epoch_us(o_orderdate) + (l_partkey % 120 - 40) * {DAY}
       - CAST(l_quantity AS BIGINT) * {HOUR} END AS q_at
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

PIPELINES = f"""pipelines AS (
 SELECT CAST(c_custkey AS VARCHAR) AS dag_id, c_mktsegment = 'BUILDING' AS is_paused,
  CASE WHEN c_custkey % 7 <> 0 THEN c_custkey % 10 <> 0 END AS is_active,
  786240000000000 + c_custkey * {HOUR} AS parsed_at,
  {pick(b.SCHEDULES, 'c_custkey % 8')} AS schedule_interval,
  c_name AS fileloc, c_mktsegment AS owners,
  CASE WHEN c_custkey % 9 <> 0 THEN c_acctbal < 0 END AS has_import_errors,
  c_nationkey AS max_active_runs, c_nationkey * 2 AS max_active_tasks,
  3 AS max_consecutive_failed_dag_runs
 FROM customer)"""

EVENT_LOGS = f"""event_logs AS (
 SELECT CAST(user_id AS VARCHAR) AS dag_id, concat(user_id, '-', event_id % 5) AS run_id,
  CASE WHEN event_id % 19 <> 0 THEN event_type END AS task_id,
  CAST(event_id % 4 AS INTEGER) AS try_number, ts AS log_ts,
  CASE WHEN event_id % 23 <> 0 THEN {pick(b.SEVERITIES, 'event_id % 4')} END AS severity,
  concat('src/', event_type, '.py:', event_id) AS source_loc,
  CASE WHEN event_id % 29 <> 0 THEN {pick(b.MESSAGES, 'event_id % 12')} END AS message,
  CASE WHEN event_id % 3 <> 0 THEN '[worker] start' || chr(10) || '  ' || {pick(b.MESSAGES, 'event_id % 12')}
       || '  ' || chr(10) END AS full_block
 FROM events)"""

ORDER_LOGS = f"""order_logs AS (
 SELECT CAST(o_custkey % 50 AS VARCHAR) AS dag_id, CAST(l_orderkey AS VARCHAR) AS run_id,
  epoch_us(o_orderdate) + l_partkey * 1000000 AS log_at,
  {pick(b.MESSAGES, 'l_partkey % 12')} AS message
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

DOC_LOGS = f"""doc_rows AS (
 SELECT doc_id, source, lang, "text" AS full_block FROM documents UNION ALL
 SELECT doc_id + {b.BLANK_LOGS}, source, lang, '  ' FROM documents WHERE doc_id % 17 = 0),
doc_logs AS (
 SELECT doc_id, source AS dag_id, lang AS run_id,
  CASE WHEN doc_id % 34 <> 0 THEN 'Timeout, retrying after 429' END AS message,
  full_block
 FROM doc_rows),
doc_body AS (
 SELECT doc_id, dag_id, run_id,
  CASE WHEN regexp_matches(full_block, '\\S') THEN full_block ELSE coalesce(message, '') END AS body
 FROM doc_logs),
doc_lines AS (
 SELECT *, CASE WHEN body = '' THEN CAST([] AS VARCHAR[])
   ELSE string_split(CASE WHEN ends_with(body, chr(10)) THEN body[:-2] ELSE body END, chr(10)) END AS lines
 FROM doc_body)"""

SCORED = f"""scored AS (
 SELECT d.source AS dag_id, CAST(l.doc_id AS VARCHAR) AS run_id, l.doc_id,
  DATE '2024-01-01' + CAST(l.doc_id % 30 AS INTEGER) AS day,
  CAST(l.toxic AS DOUBLE) AS label_failed, CAST(l.quality AS DOUBLE) AS quality,
  (d.n_chars % 997) / 997.0::DOUBLE AS p,
  CASE WHEN l.doc_id % 5 = 0 OR l.doc_id % 7 = 0 THEN NULL ELSE (d.n_chars % 997) / 997.0::DOUBLE * 1.5::DOUBLE END AS calibrated,
  CASE WHEN l.doc_id % 10 = 0 OR l.doc_id % 3 = 0 THEN NULL ELSE (d.n_chars % 997) / 997.0::DOUBLE END AS raw,
  CASE WHEN l.doc_id % 4 = 0 THEN NULL ELSE CAST(l.quality AS DOUBLE) * 2 END AS hard,
  concat_ws('|', d.lang, {pick(b.DRIVERS, 'l.doc_id % 8')}) AS top_drivers
 FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""

OBJECTS = f"""objects AS (
 SELECT doc_id, "text", replace({pick(b.OBJECT_PATHS, 'doc_id % 7')}, '{{d}}',
   strftime(DATE '2026-06-01' + CAST(doc_id % 31 AS INTEGER), '%Y%m%d')) AS path
 FROM documents)"""

WIKI_PAGES = f"""wiki0 AS (
 SELECT page_id AS i, {pick(b.PAGE_PARENTS, 'page_id % 5')} AS parent_title, html,
  strftime(DATE '2026-05-20' + CAST(page_id % 40 AS INTEGER), '%Y-%m-%d') AS d
 FROM pages),
wiki AS (
 SELECT CAST(i AS VARCHAR) AS page_id, parent_title,
  CASE WHEN i % 5 = 3 THEN 'Latest Train Metrics'
   WHEN i % 11 = 0 THEN (CASE parent_title WHEN 'Daily Reports' THEN 'Daily Report' ELSE parent_title END) || ' — 2026-13-45'
   ELSE (CASE parent_title WHEN 'Daily Reports' THEN 'Daily Report' ELSE parent_title END) || ' — ' || d END AS title,
  CASE WHEN i % 6 = 0 THEN html ELSE '<!-- AUTO-GENERATED -->' || chr(10) || html END AS body
 FROM wiki0)"""

ARTEFACT_ROWS = """artefact_rows AS (
 SELECT 'outputs/orders_' || strftime(o_orderdate, '%Y%m') || '.csv' AS target,
  'Orders & more — ' || strftime(o_orderdate, '%Y-%m') AS title,
  o_orderkey AS row_no, CAST(o_orderkey AS VARCHAR) AS order_id,
  '<' || o_orderpriority || '> & "x", ''y''' AS priority,
  CASE WHEN o_custkey % 4 <> 0 THEN 'line1' || chr(10) || 'line ' || o_custkey END AS latest_message
 FROM orders)"""
