"""Log mining, root causes and failed runs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from pipewatch.catalog import bindings as b
from pipewatch.catalog import bindings_sql as s
from pipewatch.catalog.scan_queries import IDS
from pipewatch.functions import text
from pipewatch.operators.timeline import micros
from pipewatch.plans import rca
from pipewatch.plans.logs import mined_logs, run_log_signals

QUERIES, ORACLES = {}, {}


def add(name, sql=None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def count_sql(patterns, lines="lines"):
    cond = " OR ".join(f"regexp_matches(l, '{p}', 'i')" for p in patterns)
    return f"CAST(len(list_filter({lines}, lambda l: {cond})) AS INTEGER)"


def counts_sql(group, prefix):
    return ", ".join(f"{count_sql(p)} AS {prefix}{n}" for n, p in group.items())


ERR = [f"error_cat_{k}" for k in b.DOC_ERRORS]
KW = [f"kw_{k}" for k in b.DOC_KEYWORDS]


def _mined(spark, sf):
    logs = b.document_logs(spark, sf).withColumn(
        "doc_id", ((micros("log_ts") - 1704067200000000) / 1_000_000).cast("bigint")
    )
    return mined_logs(logs, b.DOC_ERRORS, b.DOC_KEYWORDS, b.DOC_STACKTRACE)


@add("log_line_counts", f"WITH {s.DOC_LOGS} SELECT doc_id, {counts_sql(b.DOC_ERRORS, 'error_cat_')} FROM doc_lines")
def _(spark, sf):
    return _mined(spark, sf).select("doc_id", *ERR)


@add("log_keyword_counts", f"WITH {s.DOC_LOGS} SELECT doc_id, {counts_sql(b.DOC_KEYWORDS, 'kw_')} FROM doc_lines")
def _(spark, sf):
    return _mined(spark, sf).select("doc_id", *KW)


@add(
    "default_line_counts",
    f"""WITH lines AS (SELECT doc_id, string_split(CASE WHEN ends_with("text", chr(10)) THEN "text"[:-2] ELSE "text" END, chr(10)) AS lines FROM documents)
SELECT doc_id, {counts_sql(text.ERROR_PATTERNS, 'error_cat_')}, {counts_sql(text.KEYWORD_PATTERNS, 'kw_')} FROM lines""",
)
def _(spark, sf):
    d = b.table(spark, sf, "documents").withColumn(
        "_lines", text.split_lines("text")
    ).withColumn("_low", text.folded("text"))
    cols = {
        **text.line_count_columns("_lines", text.ERROR_PATTERNS, "error_cat_", "text", "_low"),
        **text.line_count_columns("_lines", text.KEYWORD_PATTERNS, "kw_", "text", "_low"),
    }
    return d.select("doc_id", *[c.alias(n) for n, c in cols.items()])


@add(
    "log_tail",
    f"""WITH {s.DOC_LOGS}
SELECT doc_id, coalesce(array_to_string(lines[-20:], chr(10)), '') AS tail,
 CAST(regexp_matches(body, '{b.DOC_STACKTRACE}') AS INTEGER) AS stacktrace_seen FROM doc_lines""",
)
def _(spark, sf):
    return _mined(spark, sf).select("doc_id", "tail", "stacktrace_seen")


_SIGNAL_SUMS = ", ".join(
    f"CAST(sum({count_sql(p)}) AS BIGINT) AS {pre}{n}"
    for pre, g in (("error_cat_", b.DOC_ERRORS), ("kw_", b.DOC_KEYWORDS))
    for n, p in g.items()
)


@add(
    "run_log_signals",
    f"""WITH {s.DOC_LOGS},
first AS (SELECT *, row_number() OVER (PARTITION BY dag_id, run_id ORDER BY doc_id) AS rn FROM doc_lines),
full_ones AS (SELECT *, row_number() OVER (PARTITION BY dag_id, run_id ORDER BY rn DESC) AS back FROM first WHERE regexp_matches(body, '\\S')),
agg AS (SELECT dag_id, run_id, count(*) AS log_objects_parsed,
 CAST(sum(CAST(regexp_matches(body, '{b.DOC_STACKTRACE}') AS INTEGER)) AS BIGINT) AS stacktrace_seen_count,
 string_agg(array_to_string(lines[-20:], chr(10)), chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rn) FILTER (back <= 3) AS last_n_lines_summary,
 {_SIGNAL_SUMS}
 FROM full_ones GROUP BY dag_id, run_id)
SELECT *, round(stacktrace_seen_count / log_objects_parsed, 6) AS stacktrace_seen_rate,
 {', '.join(f'round({c} / log_objects_parsed, 6) AS {c}_rate' for c in ERR + KW)} FROM agg""",
)
def _(spark, sf):
    sig = run_log_signals(
        b.document_logs(spark, sf), errors=b.DOC_ERRORS, keywords=b.DOC_KEYWORDS, stacktrace=b.DOC_STACKTRACE
    )
    rates = ["stacktrace_seen_rate"] + [f"{c}_rate" for c in ERR + KW]
    return sig.select(
        *[c for c in sig.columns if c not in rates and c != "logical_date"],
        *[F.round(c, 6).alias(c) for c in rates],
    )


# --- root causes ----------------------------------------------------------


def classify_sql(expr):
    arms = " ".join(
        f"WHEN regexp_matches({expr}, '{p}', 'i') THEN '{n}'" for n, p in text.ERROR_CATEGORIES
    )
    return f"CASE {arms} ELSE 'Other' END"


def hint_sql(expr):
    lines = f"list_filter(list_transform(string_split({expr}, chr(10)), lambda l: trim(l)), lambda l: l <> '')"
    named = f"list_filter({lines}, lambda l: regexp_matches(l, '^[A-Za-z][a-zA-Z0-9_.]*(Error|Exception|Warning)'))"
    return f"coalesce(substring(coalesce({named}[-1], {lines}[-1]), 1, 200), '')"


BOTH = "coalesce(message, '') || ' ' || coalesce(full_block, '')"
RANK = "CASE upper(severity) WHEN 'CRITICAL' THEN 4 WHEN 'ERROR' THEN 3 WHEN 'WARNING' THEN 2 WHEN 'INFO' THEN 1 ELSE 0 END"
WORST = f"CASE coalesce(max({RANK}), 0) WHEN 4 THEN 'CRITICAL' WHEN 3 THEN 'ERROR' WHEN 2 THEN 'WARNING' ELSE 'INFO' END"
TS = "strftime({}, '%Y-%m-%d %H:%M:%S')"


@add("error_category", f"WITH {s.EVENT_LOGS} SELECT source_loc, {classify_sql(BOTH)} AS error_category FROM event_logs")
def _(spark, sf):
    both = F.concat_ws(" ", F.coalesce("message", F.lit("")), F.coalesce("full_block", F.lit("")))
    return b.event_logs(spark, sf).select("source_loc", text.classify_error(both).alias("error_category"))


@add("document_category", f"""SELECT doc_id, {classify_sql('"text"')} AS error_category FROM documents""")
def _(spark, sf):
    return b.table(spark, sf, "documents").select("doc_id", text.classify_error("text").alias("error_category"))


@add("stack_hint", f"WITH {s.EVENT_LOGS} SELECT source_loc, {hint_sql('full_block')} AS stack_hint FROM event_logs")
def _(spark, sf):
    return b.event_logs(spark, sf).select("source_loc", text.stack_hint("full_block").alias("stack_hint"))


@add("worst_severity", f"WITH {s.EVENT_LOGS} SELECT dag_id, {WORST} AS severity FROM event_logs GROUP BY dag_id")
def _(spark, sf):
    return b.event_logs(spark, sf).groupBy("dag_id").agg(text.worst_severity("severity").alias("severity"))


def modal_sql(keys, src="event_logs"):
    return f"""modal AS (SELECT {keys}, task_id AS top_task FROM (SELECT {keys}, task_id, count(*) AS n FROM {src}
 WHERE task_id IS NOT NULL GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY n DESC, task_id) = 1)"""


@add("modal_task", f"WITH {s.EVENT_LOGS}, {modal_sql('dag_id')} SELECT * FROM modal")
def _(spark, sf):
    return rca.modal_task(b.event_logs(spark, sf), ["dag_id"])


def summary_sql(src="event_logs"):
    return f"""newest AS (SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY dag_id ORDER BY log_ts DESC) = 1),
totals AS (SELECT dag_id, {WORST} AS rca_severity, count(DISTINCT run_id) AS rca_recurrence, count(*) AS rca_error_count,
 CAST(coalesce(max(try_number), 0) AS INTEGER) AS rca_try_number_max,
 {TS.format('min(log_ts)')} AS rca_first_seen, {TS.format('max(log_ts)')} AS rca_last_seen FROM {src} GROUP BY dag_id),
{modal_sql('dag_id', src)},
summary AS (SELECT n.dag_id, {classify_sql(BOTH)} AS rca_error_category, coalesce(m.top_task, '') AS rca_top_task,
 substring(coalesce(message, ''), 1, 200) AS rca_top_error, {hint_sql('full_block')} AS rca_stack_hint,
 t.rca_severity, t.rca_recurrence, t.rca_error_count, t.rca_try_number_max, t.rca_first_seen, t.rca_last_seen
 FROM newest n JOIN totals t ON n.dag_id = t.dag_id LEFT JOIN modal m ON n.dag_id = m.dag_id)"""


@add("rca_summary", f"WITH {s.EVENT_LOGS}, {summary_sql()} SELECT * FROM summary")
def _(spark, sf):
    return rca.rca_summary(b.event_logs(spark, sf))


@add(
    "rca_top5",
    f"""WITH {s.EVENT_LOGS}
SELECT dag_id, CAST(rn AS INTEGER) AS rn, coalesce(task_id, '') AS task_id, coalesce(try_number, 0) AS try_number,
 {TS.format('log_ts')} AS log_ts, coalesce(severity, 'UNKNOWN') AS severity, substring(source_loc, 1, 100) AS source_loc,
 substring(coalesce(message, ''), 1, 200) AS message, {hint_sql('full_block')} AS stack_hint
FROM (SELECT *, row_number() OVER (PARTITION BY dag_id ORDER BY log_ts DESC) AS rn FROM event_logs) WHERE rn <= 5""",
)
def _(spark, sf):
    return rca.rca_entries(b.event_logs(spark, sf))


FAILED_SQL = f"""severe AS (SELECT * FROM event_logs WHERE log_ts > TIMESTAMP '2024-01-14' AND log_ts < TIMESTAMP '2024-01-21'
  AND upper(severity) IN ('ERROR', 'CRITICAL')),
latest AS (SELECT * FROM severe QUALIFY row_number() OVER (PARTITION BY dag_id, run_id ORDER BY log_ts DESC) = 1),
sums AS (SELECT dag_id, run_id, count(*) AS log_count, CAST(max(try_number) AS INTEGER) AS max_try_number, {WORST} AS worst_severity
 FROM severe GROUP BY dag_id, run_id),
{modal_sql('dag_id, run_id', 'severe')},
failed AS (SELECT l.dag_id, l.run_id, log_count, coalesce(top_task, '') AS top_failing_task, max_try_number, worst_severity,
 {TS.format('log_ts')} AS latest_log_ts, substring(coalesce(message, ''), 1, 300) AS latest_message,
 {classify_sql("coalesce(message, '') || ' ' || coalesce(full_block, '')")} AS error_category,
 {hint_sql('full_block')} AS stack_hint
 FROM latest l JOIN sums s ON l.dag_id = s.dag_id AND l.run_id = s.run_id
 LEFT JOIN modal m ON l.dag_id = m.dag_id AND l.run_id = m.run_id)"""


@add("failed_run_summary", f"WITH {s.EVENT_LOGS}, {FAILED_SQL} SELECT * FROM failed")
def _(spark, sf):
    return rca.failed_run_report(b.event_logs(spark, sf), date(2024, 1, 20), 7)


@add(
    "failed_run_lines",
    f"""WITH {s.EVENT_LOGS}, {FAILED_SQL} SELECT dag_id, run_id, '| ' || concat_ws(' | ', dag_id, run_id, worst_severity, log_count,
 top_failing_task, max_try_number, error_category, replace(latest_message, '|', '')) || ' |' AS line FROM failed""",
)
def _(spark, sf):
    report = rca.failed_run_report(b.event_logs(spark, sf), date(2024, 1, 20), 7)
    return rca.failed_run_lines(report).select(*IDS, "line")


def _predictions(spark, sf):
    """Event runs as predictions: risk by the run's number."""
    return b.event_runs(spark, sf).select(
        *IDS,
        F.when(F.col("run_id").cast("bigint") % 97 == 0, "High").otherwise("Low").alias("risk_bucket"),
    )


_PRED_SQL = "preds AS (SELECT dag_id, run_id, CASE WHEN CAST(run_id AS BIGINT) % 97 = 0 THEN 'High' ELSE 'Low' END AS risk_bucket FROM event_runs)"
_WANTED = """wanted AS (SELECT * FROM event_logs WHERE dag_id IN (SELECT dag_id FROM preds WHERE risk_bucket = 'High')
 AND dag_id IN (SELECT dag_id FROM event_runs WHERE state IN ('failed', 'upstream_failed', 'timeout')))"""
_DEFAULTS = ", ".join(
    f"coalesce(s.{c}, {0 if isinstance(d, int) else repr(d)}) AS {c}" for c, d in rca.RCA_DEFAULTS.items()
)


@add(
    "rca_enriched",
    f"""WITH {s.EVENT_RUNS}, {s.EVENT_LOGS}, {_PRED_SQL}, {_WANTED}, {summary_sql('wanted')}
SELECT p.dag_id, p.run_id, p.risk_bucket, {_DEFAULTS} FROM preds p LEFT JOIN summary s ON p.dag_id = s.dag_id""",
)
def _(spark, sf):
    return rca.with_root_causes(_predictions(spark, sf), b.event_logs(spark, sf), b.event_runs(spark, sf)).select(
        *IDS, "risk_bucket", *rca.RCA_DEFAULTS
    )


@add(
    "rca_markdown",
    f"""WITH {s.EVENT_RUNS}, {s.EVENT_LOGS}, {_PRED_SQL},
wanted AS (SELECT * FROM event_logs WHERE dag_id IN (SELECT dag_id FROM preds WHERE risk_bucket = 'High')), {summary_sql('wanted')},
entries AS (SELECT dag_id, string_agg(rn || '. [' || coalesce(severity, 'UNKNOWN') || '] **' || coalesce(task_id, '') || '** (try '
  || coalesce(try_number, 0) || ') ' || {TS.format('log_ts')} || chr(10) || '   > ' || substring(coalesce(message, ''), 1, 200)
  || CASE WHEN {hint_sql('full_block')} <> '' THEN chr(10) || '   > _' || {hint_sql('full_block')} || '_' ELSE '' END, chr(10) ORDER BY rn) AS txt
 FROM (SELECT *, row_number() OVER (PARTITION BY dag_id ORDER BY log_ts DESC) AS rn FROM wanted) WHERE rn <= 5 GROUP BY dag_id)
SELECT s.dag_id, concat_ws(chr(10), chr(10) || '### ' || s.dag_id, '| Field | Value |', '|---|---|',
 '| **Error Category** | ' || rca_error_category || ' |',
 '| **Top Failing Task** | ' || CASE rca_top_task WHEN '' THEN '-' ELSE rca_top_task END || ' |',
 '| **Worst Severity** | ' || rca_severity || ' |', '| **Recurrence** | ' || rca_recurrence || ' distinct run(s) with errors |',
 '| **Total Error Records** | ' || rca_error_count || ' |', '| **Max Retry Number** | ' || rca_try_number_max || ' |',
 '| **First Seen** | ' || rca_first_seen || ' |', '| **Last Seen** | ' || rca_last_seen || ' |',
 '| **Latest Error** | ' || rca_top_error || ' |',
 CASE WHEN rca_stack_hint <> '' THEN '| **Stack Hint** | ' || rca_stack_hint || ' |' END,
 chr(10) || '**Recent error entries:**' || chr(10), e.txt) AS markdown
FROM summary s JOIN entries e ON s.dag_id = e.dag_id""",
)
def _(spark, sf):
    return rca.rca_markdown(rca.root_cause_details(_predictions(spark, sf), b.event_logs(spark, sf)))
