"""Artefact discovery, publish plan, page bodies, retention."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from pipewatch.catalog import bindings as b
from pipewatch.catalog import bindings_sql as s
from pipewatch.functions import scalars
from pipewatch.operators.ranking import latest_version, with_group_index
from pipewatch.plans import publish, report
from pipewatch.settings import PublishSettings

QUERIES, ORACLES = {}, {}
TODAY = date(2026, 6, 20)
LOOKBACK = 9


def add(name, sql=None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


FOUND_SQL = f"""{s.OBJECTS},
dated AS (SELECT DISTINCT CASE
  WHEN regexp_matches(path, '/outputs/failed_runs_rca_[0-9]{{8}}.csv$') THEN 'outputs/failed_runs_rca_{{date}}.csv'
  WHEN regexp_matches(path, '/outputs/grid_cv_predictions_[0-9]{{8}}.csv$') THEN 'outputs/grid_cv_predictions_{{date}}.csv'
  WHEN regexp_matches(path, '/outputs/failed_runs_rca_report_[0-9]{{8}}.md$') THEN 'outputs/failed_runs_rca_report_{{date}}.md'
  WHEN regexp_matches(path, '/outputs/report_[0-9]{{8}}.md$') THEN 'outputs/report_{{date}}.md' END AS path_template,
  strptime(nullif(regexp_extract(path, '_([0-9]{{8}})\\.', 1), ''), '%Y%m%d') AS d FROM objects),
specs AS (SELECT * FROM (VALUES
  ('outputs/failed_runs_rca_{{date}}.csv', 'Failed Runs RCA — ', 'Failed Runs RCA', 'csv'),
  ('outputs/grid_cv_predictions_{{date}}.csv', 'Daily Predictions — ', 'Daily Predictions', 'csv'),
  ('outputs/failed_runs_rca_report_{{date}}.md', 'Failed Runs RCA Report — ', 'Failed Runs RCA Reports', 'md'),
  ('outputs/report_{{date}}.md', 'Daily Report — ', 'Daily Reports', 'md')) v(path_template, head, parent_title, render_kind)),
found AS (SELECT s.path_template, parent_title, render_kind, TRUE AS dated, strftime(d, '%Y-%m-%d') AS artefact_date,
  replace(s.path_template, '{{date}}', strftime(d, '%Y%m%d')) AS target, head || strftime(d, '%Y-%m-%d') AS title
 FROM specs s JOIN dated USING (path_template) WHERE d BETWEEN TIMESTAMP '2026-06-11' AND TIMESTAMP '2026-06-20'
 UNION ALL SELECT * FROM (VALUES
  ('artefacts/grid_cv_train_metrics.json', 'Train Metrics', 'json', FALSE, CAST(NULL AS VARCHAR), 'artefacts/grid_cv_train_metrics.json', 'Latest Train Metrics'),
  ('artefacts/grid_cv_feature_importance.csv', 'Feature Importance', 'csv', FALSE, NULL, 'artefacts/grid_cv_feature_importance.csv', 'Latest Feature Importance')))"""


def _found(spark, sf):
    return publish.discover(b.document_objects(spark, sf), TODAY, LOOKBACK)


@add(
    "artefact_discovery",
    f"WITH {FOUND_SQL} SELECT path_template, parent_title, render_kind, artefact_date, target, title FROM found",
)
def _(spark, sf):
    return _found(spark, sf).select(
        "path_template", "parent_title", "render_kind",
        scalars.iso_date("artefact_date").alias("artefact_date"), "target", "title",
    )


@add("content_hash", """SELECT doc_id, sha256("text") AS content_hash, strlen("text") AS raw_bytes FROM documents""")
def _(spark, sf):
    return b.table(spark, sf, "documents").select(
        "doc_id", publish.text_hash("text").alias("content_hash"),
        scalars.byte_length("text").cast("bigint").alias("raw_bytes"),
    )


# The newest document stored under each path is its content.
CONTENT_SQL = """content AS (SELECT regexp_replace(path, '^base/', '') AS target, sha256("text") AS content_hash FROM objects
 QUALIFY row_number() OVER (PARTITION BY path ORDER BY doc_id DESC) = 1)"""


def _content(spark, sf):
    newest = latest_version(b.document_objects(spark, sf), ["path"], [F.desc("doc_id")])
    return newest.select(
        F.regexp_replace("path", "^base/", "").alias("target"), publish.text_hash("text").alias("content_hash")
    )


def _state(content):
    """Markers of rolling artefacts as a former run would have left them."""
    text = F.to_json(
        F.struct(
            F.lit("77").alias("page_id"),
            # About half of them were published with other content.
            F.when(F.col("content_hash") >= "8", F.col("content_hash")).otherwise("older").alias("content_hash"),
            "target",
            F.lit("2026-06-01T00:00:00+00:00").alias("published_at"),
        )
    )
    rolling = content.where("target LIKE 'artefacts/%'").select(
        scalars.state_key("target").alias("state_key"), text.alias("text")
    )
    return publish.parse_markers(rolling)


@add(
    "publish_plan",
    f"""WITH {FOUND_SQL}, {s.WIKI_PAGES}, {CONTENT_SQL}
SELECT path_template, f.target, f.title, replace(replace(replace(f.target, '/', '_'), '.', '_'), ' ', '_') AS state_key, c.content_hash,
 CASE WHEN NOT dated AND c.content_hash IS NOT NULL THEN '77' END AS page_id,
 CASE WHEN dated AND f.title IN (SELECT title FROM wiki) THEN 'skipped_existing' WHEN c.content_hash IS NULL THEN 'error'
  WHEN NOT dated AND c.content_hash >= '8' THEN 'skipped_unchanged' ELSE 'publish' END AS action
FROM found f LEFT JOIN content c ON c.target = f.target""",
)
def _(spark, sf):
    content = _content(spark, sf)
    return publish.publish_plan(_found(spark, sf), b.wiki_pages(spark, sf), content, _state(content)).select(
        "path_template", "target", "title", "state_key", "content_hash", "page_id", "action"
    )


@add(
    "outcome_summary",
    f"""WITH {FOUND_SQL}, {s.WIKI_PAGES}, {CONTENT_SQL}
SELECT action, count(*) AS n FROM (SELECT CASE WHEN dated AND f.title IN (SELECT title FROM wiki) THEN 'skipped_existing'
  WHEN c.content_hash IS NULL THEN 'error' WHEN NOT dated AND c.content_hash >= '8' THEN 'skipped_unchanged' ELSE 'publish' END AS action
 FROM found f LEFT JOIN content c ON c.target = f.target) GROUP BY action""",
)
def _(spark, sf):
    content = _content(spark, sf)
    return publish.outcome_summary(
        publish.publish_plan(_found(spark, sf), b.wiki_pages(spark, sf), content, _state(content))
    )


@add(
    "state_upsert",
    f"""WITH {s.OBJECTS}, m AS (SELECT replace(replace(path, '/', '_'), '.', '_') AS state_key, doc_id, sha256("text") AS content_hash FROM objects)
SELECT state_key, CAST(doc_id AS VARCHAR) AS page_id, content_hash FROM m
QUALIFY row_number() OVER (PARTITION BY state_key ORDER BY doc_id DESC) = 1""",
)
def _(spark, sf):
    rows = b.document_objects(spark, sf).select(
        scalars.state_key("path").alias("state_key"),
        F.col("doc_id").cast("string").alias("page_id"),
        publish.text_hash("text").alias("content_hash"),
        F.col("path").alias("target"),
        F.lpad(F.col("doc_id").cast("string"), 20, "0").alias("published_at"),
        (F.col("doc_id") % 2).alias("_old"),
    )
    state = publish.upsert_state(rows.where("_old = 1"), rows.where("_old = 0"))
    return state.select("state_key", "page_id", "content_hash")


# --- tables as pages ------------------------------------------------------

COLUMNS = ["order_id", "priority", "latest_message"]
CAP = PublishSettings(row_cap=150, warn_bytes=20_000, hard_limit_bytes=40_000)
GENERATED = "2026-06-20T06:00:00+00:00"


def _numbered(spark, sf):
    """Rows with their position inside the artefact, from 0."""
    return with_group_index(b.artefact_rows(spark, sf), ["target"], ["row_no"])


def esc(c):
    return (
        f"replace(replace(replace(replace(replace(coalesce({c}, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'),"
        " '\"', '&quot;'), '''', '&#x27;')"
    )


TR = (
    f"'<tr><td>' || {esc('order_id')} || '</td><td>' || {esc('priority')} || '</td><td><div style=\"{publish.WIDE_STYLE}\">'"
    f" || replace({esc('latest_message')}, chr(10), '<br/>') || '</div></td></tr>'"
)
CSV = " || ',' || ".join(
    f"CASE WHEN regexp_matches(coalesce({c}, ''), '[,\"\\r\\n]') THEN '\"' || replace({c}, '\"', '\"\"') || '\"' ELSE coalesce({c}, '') END"
    for c in COLUMNS
)
PAGE_SQL = f"""{s.ARTEFACT_ROWS},
numbered AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY row_no) AS rn, count(*) OVER (PARTITION BY target) AS rows_total FROM artefact_rows)"""


@add(
    "page_rows",
    f"""WITH {PAGE_SQL} SELECT target, rows_total, {TR} AS tr FROM numbered WHERE rn <= 150""",
)
def _(spark, sf):
    capped = publish.capped_rows(b.artefact_rows(spark, sf), CAP.row_cap)
    return capped.select("target", "rows_total", publish.row_markup(COLUMNS, CAP.wide_cell_columns).alias("tr"))


@add(
    "page_rows_large_cap",
    """WITH o AS (SELECT o_orderstatus AS target, o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS rn,
 count(*) OVER (PARTITION BY o_orderstatus) AS rows_total FROM orders) SELECT target, rows_total, o_orderkey AS row_no FROM o WHERE rn <= 3000""",
)
def _(spark, sf):
    o = b.table(spark, sf, "orders").select(F.col("o_orderstatus").alias("target"), F.col("o_orderkey").alias("row_no"))
    return publish.capped_rows(o, 3000).select("target", "rows_total", "row_no")


# Hashes of ten thousand lines' hashes at a time.
CHUNK_SQL = f"""chunks AS (SELECT target, (rn - 1) // 10000 AS chunk_no, count(*) AS row_count, sum(strlen({CSV}) + 1)::BIGINT AS payload_bytes,
 sha256(string_agg(sha256({CSV} || chr(10)), '' ORDER BY rn)) AS chunk_hash FROM numbered GROUP BY ALL)"""


@add("attachment_chunks", f"WITH {PAGE_SQL}, {CHUNK_SQL} SELECT target, chunk_no, row_count, payload_bytes, chunk_hash FROM chunks")
def _(spark, sf):
    return publish.payload_chunks(_numbered(spark, sf), COLUMNS)


@add(
    "table_hash",
    f"""WITH {PAGE_SQL}, {CHUNK_SQL}
SELECT target, sha256('order_id,priority,latest_message' || chr(10) || string_agg(chunk_hash, '' ORDER BY chunk_no)) AS content_hash,
 33 + sum(payload_bytes)::BIGINT AS raw_bytes, sum(row_count)::BIGINT AS row_count FROM chunks GROUP BY target""",
)
def _(spark, sf):
    return publish.table_hash(_numbered(spark, sf), COLUMNS)


NOTABLE = ["dag_id", "run_id", "risk_bucket"]


@add(
    "notable_risk_hash",
    f"""WITH {s.SCORED}, r AS (SELECT 'outputs/grid_cv_predictions_' || strftime(day, '%Y%m%d') || '.csv' AS target, doc_id, dag_id, run_id,
  CASE WHEN p >= 0.7 THEN 'High' WHEN p >= 0.4 THEN 'Med' ELSE 'Low' END AS risk_bucket FROM scored),
n AS (SELECT target, row_number() OVER (PARTITION BY target ORDER BY doc_id) - 1 AS i, sha256(dag_id || ',' || run_id || ',' || risk_bucket || chr(10)) AS h
 FROM r WHERE risk_bucket <> 'Low'),
c AS (SELECT target, i // 10000 AS chunk_no, sha256(string_agg(h, '' ORDER BY i)) AS chunk_hash, count(*) AS k FROM n GROUP BY ALL)
SELECT target, sha256('dag_id,run_id,risk_bucket' || chr(10) || string_agg(chunk_hash, '' ORDER BY chunk_no)) AS content_hash,
 sum(k)::BIGINT AS row_count FROM c GROUP BY target""",
)
def _(spark, sf):
    rows = report.with_risk(b.scored_rows(spark, sf)).select(
        F.concat(F.lit("outputs/grid_cv_predictions_"), F.date_format("day", "yyyyMMdd"), F.lit(".csv")).alias("target"),
        F.col("run_id").cast("bigint").alias("row_no"), *NOTABLE,
    )
    kept = with_group_index(publish.kept_rows(rows, "risk_bucket", ["Med", "High"]), ["target"], ["row_no"])
    return publish.table_hash(kept, NOTABLE).select("target", "content_hash", "row_count")


_FOOT = (
    f"'<hr/><p><em>Source: <code>store/' || target || '</code><br/>Generated: {GENERATED}' || {{rows}} || '</em></p>'"
)
BODY_SQL = f"""{PAGE_SQL},
cut AS (SELECT target, title, rows_total, string_agg({TR}, '' ORDER BY rn) AS trs FROM numbered WHERE rn <= 150 GROUP BY ALL),
raw AS (SELECT target, 31 + sum(strlen({CSV}) + 1) AS raw_bytes FROM numbered GROUP BY target),
whole AS (SELECT c.target, title, raw_bytes, '<!-- AUTO-GENERATED -->' || chr(10) || '<h1>' || {esc('title')} || '</h1>'
 || CASE WHEN rows_total > 150 THEN '<p><strong>Truncated at first 150 rows of ' || rows_total || ' total.</strong></p>' ELSE '' END
 || '<table><thead><tr><th>order_id</th><th>priority</th><th>latest_message</th></tr></thead><tbody>' || trs || '</tbody></table>'
 || {_FOOT.format(rows="'<br/>Rows: ' || rows_total").replace('target', 'c.target')} AS full_body
 FROM cut c JOIN raw r ON c.target = r.target),
sized AS (SELECT *, strlen(full_body) AS attempted_bytes, CASE WHEN strlen(full_body) >= 40000 THEN 'placeholder'
 WHEN strlen(full_body) >= 20000 THEN 'warn' ELSE 'ok' END AS size_verdict FROM whole)"""
_NOTICE = (
    "'<p><strong>Inline rendering skipped.</strong> The source artefact is ' || format('{:,}', CAST(raw_bytes AS BIGINT)) || ' bytes — rendering it as an XHTML"
    " table would exceed the page body size limit (attempted body size: ' || format('{:,}', attempted_bytes) || ' bytes). The full raw data is"
    " available as the attachment on this page.</p>'"
)


@add(
    "page_bodies",
    f"""WITH {BODY_SQL} SELECT target, title, size_verdict, attempted_bytes, CASE size_verdict WHEN 'placeholder' THEN
 '<!-- AUTO-GENERATED -->' || chr(10) || '<h1>' || {esc('title')} || '</h1>' || {_NOTICE} || {_FOOT.format(rows="''")}
 ELSE full_body END AS body FROM sized""",
)
def _(spark, sf):
    pages = publish.table_pages(b.artefact_rows(spark, sf), COLUMNS, "store", GENERATED, CAP)
    return pages.select("target", "title", "size_verdict", "attempted_bytes", "body")


GATE = PublishSettings(warn_bytes=4_000, hard_limit_bytes=8_000)


@add(
    "size_gate",
    f"""WITH t AS (SELECT doc_id, '<!-- AUTO-GENERATED -->' || chr(10) || '<h1>Doc ' || doc_id || '</h1><pre>' || {esc('"text"')}
  || '</pre><hr/><p><em>Source: <code>store/docs/' || doc_id || '.md</code><br/>Generated: {GENERATED}</em></p>' AS body FROM documents)
SELECT doc_id, strlen(body) AS attempted_bytes, CASE WHEN strlen(body) >= 8000 THEN 'placeholder' WHEN strlen(body) >= 4000 THEN 'warn' ELSE 'ok' END AS size_verdict,
 CASE WHEN strlen(body) < 8000 THEN sha256(body) END AS body_hash FROM t""",
)
def _(spark, sf):
    i = F.col("doc_id").cast("string")
    docs = b.table(spark, sf, "documents").select(
        F.concat(F.lit("docs/"), i, F.lit(".md")).alias("target"), F.concat(F.lit("Doc "), i).alias("title"), "text"
    )
    pages = publish.text_pages(docs, "store", GENERATED, GATE)
    return pages.select(
        F.regexp_extract("target", r"(\d+)", 1).cast("bigint").alias("doc_id"),
        F.col("attempted_bytes").cast("bigint").alias("attempted_bytes"),
        "size_verdict",
        F.when(F.col("size_verdict") != "placeholder", F.sha2("body", 256)).alias("body_hash"),
    )


# With the limits of production, all rows and all texts.
WHOLE = PublishSettings()
ROOM = publish.part_room(WHOLE)


@add(
    "page_parts",
    f"""WITH {PAGE_SQL}, sized AS (SELECT *, (rn - 1) // {WHOLE.row_cap} AS block, {TR} AS tr FROM numbered),
cut AS (SELECT *, CAST((sum(strlen(tr)) OVER (PARTITION BY target, block ORDER BY rn) - strlen(tr)) AS BIGINT) // {ROOM} AS sub FROM sized),
parts AS (SELECT target, title, rows_total, min(rn) AS a, count(*) AS row_count, string_agg(tr, '' ORDER BY rn) AS trs FROM cut GROUP BY target, title, rows_total, block, sub)
SELECT target, row_number() OVER (PARTITION BY target ORDER BY a) AS page_no, a - 1 AS first_row, row_count, sha256('<!-- AUTO-GENERATED -->' || chr(10) || '<h1>' || {esc('title')} || '</h1>'
 || '<p>Rows ' || a || ' to ' || (a + row_count - 1) || ' of ' || rows_total || '.</p>'
 || '<table><thead><tr><th>order_id</th><th>priority</th><th>latest_message</th></tr></thead><tbody>' || trs || '</tbody></table>'
 || {_FOOT.format(rows="'<br/>Rows: ' || rows_total")}) AS body_hash FROM parts""",
)
def _(spark, sf):
    parts = publish.table_parts(b.artefact_rows(spark, sf), COLUMNS, "store", GENERATED, WHOLE)
    return parts.select("target", "page_no", "first_row", "row_count", F.sha2("body", 256).alias("body_hash"))


@add(
    "text_parts",
    f"""WITH t AS (SELECT doc_id, coalesce("text", '') AS whole, unnest(range(1 + greatest(0, (length(coalesce("text", '')) - 1) // {ROOM // 6}))) AS part FROM documents)
SELECT doc_id, part + 1 AS page_no, sha256('<!-- AUTO-GENERATED -->' || chr(10) || '<h1>Doc ' || doc_id || '</h1><pre>' || {esc(f'substr(whole, part * {ROOM // 6} + 1, {ROOM // 6})')}
  || '</pre><hr/><p><em>Source: <code>store/docs/' || doc_id || '.md</code><br/>Generated: {GENERATED}</em></p>') AS body_hash FROM t""",
)
def _(spark, sf):
    i = F.col("doc_id").cast("string")
    docs = b.table(spark, sf, "documents").select(
        F.concat(F.lit("docs/"), i, F.lit(".md")).alias("target"), F.concat(F.lit("Doc "), i).alias("title"), "text"
    )
    return publish.text_parts(docs, "store", GENERATED, WHOLE).select(
        F.regexp_extract("target", r"(\d+)", 1).cast("bigint").alias("doc_id"), "page_no", F.sha2("body", 256).alias("body_hash")
    )


@add(
    "attachments",
    f"""WITH {FOUND_SQL} SELECT target, regexp_extract(target, '([^/]*)$', 1) AS attachment_filename,
 CASE render_kind WHEN 'csv' THEN 'text/csv' WHEN 'md' THEN 'text/markdown' ELSE 'application/json' END AS attachment_content_type FROM found""",
)
def _(spark, sf):
    return publish.with_attachment(_found(spark, sf)).select(
        "target", "attachment_filename", "attachment_content_type"
    )


@add(
    "retention_sweep",
    f"""WITH {s.WIKI_PAGES}, t AS (SELECT *, try_strptime(nullif(regexp_extract(title, '— *([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}) *$', 1), ''), '%Y-%m-%d') AS d FROM wiki
 WHERE parent_title <> 'Elsewhere')
SELECT page_id, parent_title, title, strftime(d, '%Y-%m-%d') AS page_date, CASE WHEN d IS NULL THEN 'kept_rolling' WHEN d >= TIMESTAMP '2026-06-06' THEN 'kept_recent'
 WHEN NOT contains(body, '<!-- AUTO-GENERATED -->') THEN 'kept_human_owned' ELSE 'deleted' END AS action FROM t""",
)
def _(spark, sf):
    sweep = publish.retention_sweep(b.wiki_pages(spark, sf), TODAY)
    return sweep.select("page_id", "parent_title", "title", scalars.iso_date("page_date").alias("page_date"), "action")


@add(
    "json_flatten",
    """SELECT event_id, '$.k' AS path, 1 AS depth, json_extract_string(props, '$.k') AS value FROM events
UNION ALL SELECT event_id, '$.m.u', 2, CAST(user_id AS VARCHAR) FROM events
UNION ALL SELECT event_id, '$.m.deep', 2, '{"t":"' || event_type || '"}' FROM events
UNION ALL SELECT event_id, '$.list[' || i || ']', 2, CAST(event_id + i AS VARCHAR) FROM events, (SELECT unnest([0, 1]) AS i)""",
)
def _(spark, sf):
    e = b.table(spark, sf, "events")
    text = F.concat(
        F.regexp_replace("props", r"\}$", ""),
        F.lit(', "m": {"u": '), F.col("user_id").cast("string"), F.lit(', "deep": {"t": "'), F.col("event_type"),
        F.lit('"}}, "list": ['), F.col("event_id").cast("string"), F.lit(","), (F.col("event_id") + 1).cast("string"), F.lit("]}"),
    )
    return publish.json_rows(e.withColumn("text", text), "event_id", "text").drop("is_container")
