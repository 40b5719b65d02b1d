"""Scans, labels, features: queries with their DuckDB counterparts."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from pipewatch.catalog import bindings as b
from pipewatch.catalog import bindings_sql as s
from pipewatch.functions.schedule import schedule_due
from pipewatch.operators.ranking import latest_version
from pipewatch.operators.timeline import micros
from pipewatch.plans import features as ft
from pipewatch.plans.logs import run_log_signals
from pipewatch.schemas import RUNS, conform
from pipewatch.settings import DAY
from pipewatch.sources import tables

CFG = ft.FramePlan(critical_tasks=("1", "3"))
IDS = ["dag_id", "run_id"]
TARGET_DAY = date(1998, 6, 1)


def r6(*names):
    return [F.round(n, 6).alias(n) for n in names]


def q6(*names, src=""):
    return ", ".join(f"round({src}{n}, 6) AS {n}" for n in names)


QUERIES, ORACLES = {}, {}


def add(name, sql=None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


# --- scans ----------------------------------------------------------------


@add(
    "latest_version",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       epoch_us(l_shipdate) AS ship_us
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1""",
)
def _(spark, sf):
    order = [F.desc(c) for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")]
    return latest_version(b.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], order).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        micros("l_shipdate").alias("ship_us"),
    )


@add(
    "conform_runs",
    f"""WITH {s.ORDER_RUNS}
SELECT dag_id, run_id, state, run_type, CAST(external_trigger AS INTEGER) AS external_trigger,
  clear_number, CAST(NULL AS BIGINT) AS queued_us, at_us AS start_us, at_us + dur AS end_us
FROM order_runs""",
)
def _(spark, sf):
    return conform(b.order_runs(spark, sf), RUNS).select(
        "dag_id", "run_id", "state", "run_type",
        F.col("external_trigger").cast("int").alias("external_trigger"),
        "clear_number",
        micros("queued_at").alias("queued_us"),
        micros("start_date").alias("start_us"),
        micros("end_date").alias("end_us"),
    )


@add(
    "date_range_scan",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-07-01'""",
)
def _(spark, sf):
    cond = tables.date_range("o_orderdate", date(1997, 1, 1), date(1997, 6, 30))
    return b.table(spark, sf, "orders").where(cond).select("o_orderkey", "o_custkey", "o_totalprice")


@add(
    "semi_join_scan",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey IN
  (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-01')""",
)
def _(spark, sf):
    recent = (
        b.table(spark, sf, "orders")
        .where(F.col("o_orderdate") >= F.lit(datetime(2001, 7, 1)))
        .select(F.col("o_custkey").alias("c_custkey"))
    )
    return tables.related_rows(b.table(spark, sf, "customer"), recent, ["c_custkey"]).select("c_custkey", "c_name")


@add(
    "run_log_scan",
    f"""WITH {s.ORDER_RUNS}, {s.ORDER_LOGS},
span AS (SELECT min(at_us) - 2 * {s.DAY} AS lo, max(at_us) + 2 * {s.DAY} AS hi FROM order_runs)
SELECT l.dag_id, l.run_id, l.log_at AS log_us, r.at_us AS logical_us, l.message
FROM order_logs l JOIN order_runs r ON l.dag_id = r.dag_id AND l.run_id = r.run_id, span
WHERE l.log_at BETWEEN lo AND hi""",
)
def _(spark, sf):
    return tables.logs_of_runs(b.order_logs(spark, sf), b.order_runs(spark, sf)).select(
        *IDS, micros("log_ts").alias("log_us"), micros("logical_date").alias("logical_us"), "message"
    )


@add(
    "failed_pipeline_logs",
    f"""WITH {s.EVENT_RUNS}, {s.EVENT_LOGS},
kept AS (SELECT l.* FROM event_logs l WHERE l.dag_id IN (SELECT dag_id FROM event_runs WHERE state = 'failed'))
SELECT dag_id, run_id, epoch_us(log_ts) AS log_us, severity FROM kept""",
)
def _(spark, sf):
    failed = tables.failed_pipelines(b.event_runs(spark, sf))
    return tables.logs_of_pipelines(b.event_logs(spark, sf), failed).select(
        *IDS, micros("log_ts").alias("log_us"), "severity"
    )


@add(
    "severe_log_scan",
    f"""WITH {s.EVENT_LOGS}
SELECT dag_id, run_id, epoch_us(log_ts) AS log_us, severity FROM event_logs
WHERE log_ts > TIMESTAMP '2024-01-10' AND log_ts < TIMESTAMP '2024-01-20'
 AND upper(severity) IN ('ERROR', 'CRITICAL')""",
)
def _(spark, sf):
    return tables.error_logs_between(
        b.event_logs(spark, sf), datetime(2024, 1, 10), datetime(2024, 1, 20)
    ).select(*IDS, micros("log_ts").alias("log_us"), "severity")


# --- targets --------------------------------------------------------------


@add(
    "label_targets",
    f"""WITH {s.ORDER_RUNS}
SELECT dag_id, run_id, CASE state WHEN 'failed' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label_failed
FROM order_runs WHERE state IN ('failed', 'success')""",
)
def _(spark, sf):
    kept, _dropped = ft.training_targets(b.order_runs(spark, sf))
    return kept.select(*IDS, "label_failed")


@add(
    "dropped_targets",
    f"""WITH {s.ORDER_RUNS} SELECT dag_id, run_id, state FROM order_runs WHERE state = 'running'""",
)
def _(spark, sf):
    _kept, dropped = ft.training_targets(b.order_runs(spark, sf))
    return dropped.select(*IDS, "state")


@add(
    "day_targets",
    f"""WITH {s.ORDER_RUNS} SELECT dag_id, run_id, at_us AS logical_us FROM order_runs
WHERE logical_date >= TIMESTAMP '1998-06-01' AND logical_date < TIMESTAMP '1998-06-02'""",
)
def _(spark, sf):
    return ft.day_targets(b.order_runs(spark, sf), TARGET_DAY).select(*IDS, micros("logical_date").alias("logical_us"))


# --- windows --------------------------------------------------------------

WINDOW_COLS = [f"{n}_{w}d" for w in (7, 30, 90) for n in ("failure_rate", "runs_count")]


def history_sql(runs):
    aggs = ",\n  ".join(
        f"avg(CASE WHEN h.state IN ('failed', 'upstream_failed', 'timeout') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"
        f" FILTER (h.at_us >= t.at_us - {w} * {DAY}) AS failure_rate_{w}d,"
        f" count(h.run_id) FILTER (h.at_us >= t.at_us - {w} * {DAY}) AS runs_count_{w}d"
        for w in (7, 30, 90)
    )
    return f"""hist AS (SELECT t.dag_id, t.run_id, {aggs}
 FROM {runs} t LEFT JOIN {runs} h ON h.dag_id = t.dag_id AND h.at_us < t.at_us AND h.at_us >= t.at_us - 90 * {DAY}
 GROUP BY t.dag_id, t.run_id)"""


def duration_sql(runs):
    return f"""durs AS (SELECT t.dag_id, t.run_id, avg(h.dur) / 1e6::DOUBLE AS mean_duration_30d,
  quantile_cont(h.dur, 0.95) / 1e6::DOUBLE AS p95_duration_30d, stddev_pop(h.dur / 1e6::DOUBLE) AS duration_std_30d
 FROM {runs} t LEFT JOIN {runs} h ON h.dag_id = t.dag_id AND h.at_us < t.at_us AND h.at_us >= t.at_us - 30 * {DAY}
 GROUP BY t.dag_id, t.run_id)"""


def streak_sql(runs):
    return f"""numbered AS (SELECT *, row_number() OVER (PARTITION BY dag_id ORDER BY at_us, run_id) AS rn FROM {runs}),
streaks AS (SELECT t.dag_id, t.run_id, count(h.rn) - coalesce(max(h.rn) FILTER (h.state <> 'failed'), 0) AS consecutive_failures
 FROM {runs} t LEFT JOIN numbered h ON h.dag_id = t.dag_id AND h.at_us < t.at_us
 GROUP BY t.dag_id, t.run_id)"""


def task_sql(runs, tasks):
    t30 = f"coalesce(h.s_at, h.q_at) >= t.at_us - 30 * {DAY}"
    q7 = f"h.q_at >= t.at_us - 7 * {DAY}"

    def rate(cond, flt):
        return f"avg(CASE WHEN {cond} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) FILTER ({flt})"

    return f"""task_hist AS (SELECT t.dag_id, t.run_id,
  avg(coalesce(h.try_number, 0) - 1) FILTER ({t30}) AS avg_retries_30d,
  {rate('coalesce(h.try_number, 0) > 1', t30)} AS retry_rate_30d,
  {rate("h.state IN ('failed', 'upstream_failed', 'skipped')", t30)} AS failed_tasks_rate_30d,
  {rate("h.state IN ('failed', 'upstream_failed')", t30 + " AND h.task_id IN ('1', '3')")} AS critical_tasks_failed_rate_30d,
  avg(h.s_at - h.q_at) FILTER ({q7}) / 1e6::DOUBLE AS avg_queue_time_7d
 FROM {runs} t LEFT JOIN {tasks} h ON h.dag_id = t.dag_id AND h.run_at < t.at_us
 GROUP BY t.dag_id, t.run_id)"""


# Range joins state the meaning.
def pressure_sql(runs, tasks):
    return f"""conc AS (SELECT t.dag_id, t.run_id, count(h.run_id) AS concurrent_runs_proxy
 FROM {runs} t LEFT JOIN (SELECT * FROM {runs} WHERE state = 'running') h
  ON h.at_us BETWEEN t.at_us - {s.HOUR} AND t.at_us + {s.HOUR} GROUP BY t.dag_id, t.run_id),
pool AS (SELECT t.dag_id, t.run_id,
  count(h.q_at) FILTER (h.q_at >= t.at_us - {s.HOUR}) AS pool_pressure_proxy_1h,
  count(h.q_at) AS pool_pressure_proxy_24h
 FROM {runs} t LEFT JOIN {tasks} h ON h.q_at BETWEEN t.at_us - 24 * {s.HOUR} AND t.at_us
 GROUP BY t.dag_id, t.run_id)"""


DUR_COLS = ["mean_duration_30d", "p95_duration_30d", "duration_std_30d"]
TASK_COLS = [
    "avg_retries_30d", "retry_rate_30d", "failed_tasks_rate_30d",
    "critical_tasks_failed_rate_30d", "avg_queue_time_7d",
]
PRESSURE_COLS = ["concurrent_runs_proxy", "pool_pressure_proxy_1h", "pool_pressure_proxy_24h"]
RATE_COLS = [c for c in WINDOW_COLS if c.startswith("failure")]
COUNT_COLS = [c for c in WINDOW_COLS if c.startswith("runs")]


@add(
    "failure_rate_windows",
    f"""WITH {s.EVENT_RUNS}, {history_sql('event_runs')}
SELECT dag_id, run_id, {q6(*RATE_COLS)}, {', '.join(COUNT_COLS)} FROM hist""",
)
def _(spark, sf):
    runs = b.event_runs(spark, sf)
    return ft.with_history(runs, runs, CFG).select(*IDS, *r6(*RATE_COLS), *COUNT_COLS)


@add(
    "failure_rate_windows_orders",
    f"""WITH {s.ORDER_RUNS}, {history_sql('order_runs')}
SELECT dag_id, run_id, {q6(*RATE_COLS)}, {', '.join(COUNT_COLS)} FROM hist""",
)
def _(spark, sf):
    runs = b.order_runs(spark, sf)
    return ft.with_history(runs, runs, CFG).select(*IDS, *r6(*RATE_COLS), *COUNT_COLS)


@add(
    "duration_stats_30d",
    f"""WITH {s.ORDER_RUNS}, {duration_sql('order_runs')} SELECT dag_id, run_id, {q6(*DUR_COLS)} FROM durs""",
)
def _(spark, sf):
    runs = b.order_runs(spark, sf)
    return ft.with_durations(runs, runs, CFG).select(*IDS, *r6(*DUR_COLS))


@add(
    "failure_streak",
    f"""WITH {s.ORDER_RUNS}, {streak_sql('order_runs')} SELECT dag_id, run_id, consecutive_failures FROM streaks""",
)
def _(spark, sf):
    runs = b.order_runs(spark, sf)
    return ft.with_streaks(runs, runs, CFG).select(*IDS, "consecutive_failures")


_TASK_BASE = f"WITH {s.ORDER_RUNS}, {s.ORDER_TASKS}, {task_sql('order_runs', 'order_tasks')}"


def _task_query(cols):
    def run(spark, sf):
        runs = b.order_runs(spark, sf)
        return ft.with_task_history(runs, b.order_tasks(spark, sf), runs, CFG).select(*IDS, *r6(*cols))

    return run


for _name, _cols in {
    "task_retry_features": TASK_COLS[:2],
    "task_fail_rates": TASK_COLS[2:4],
    "queue_time_7d": TASK_COLS[4:],
}.items():
    add(_name, f"{_TASK_BASE} SELECT dag_id, run_id, {q6(*_cols)} FROM task_hist")(_task_query(_cols))

_EVENT_TASKS = "event_tasks AS (SELECT dag_id, run_id, at_us AS q_at FROM event_runs)"
_PRESSURE_BASE = f"WITH {s.EVENT_RUNS}, {_EVENT_TASKS}, {pressure_sql('event_runs', 'event_tasks')}"


@add("concurrent_runs", f"{_PRESSURE_BASE} SELECT dag_id, run_id, concurrent_runs_proxy FROM conc")
def _(spark, sf):
    runs = b.event_runs(spark, sf)
    return ft.with_pressure(runs, b.event_tasks(spark, sf), runs, CFG).select(*IDS, "concurrent_runs_proxy")


@add(
    "pool_pressure",
    f"{_PRESSURE_BASE} SELECT dag_id, run_id, pool_pressure_proxy_1h, pool_pressure_proxy_24h FROM pool",
)
def _(spark, sf):
    runs = b.event_runs(spark, sf)
    return ft.with_pressure(runs, b.event_tasks(spark, sf), runs, CFG).select(*IDS, *PRESSURE_COLS[1:])


CALENDAR_SQL = """CAST(extract('hour' FROM logical_date) AS INTEGER) AS hour_of_day,
  CAST(extract('isodow' FROM logical_date) - 1 AS INTEGER) AS day_of_week,
  CAST(extract('isodow' FROM logical_date) >= 6 AS INTEGER) AS is_weekend,
  CAST(extract('day' FROM logical_date) >= extract('day' FROM last_day(logical_date)) - 1 AS INTEGER) AS month_end_flag"""
CAL_COLS = ["hour_of_day", "day_of_week", "is_weekend", "month_end_flag"]


@add("calendar_features", f"WITH {s.EVENT_RUNS} SELECT dag_id, run_id, {CALENDAR_SQL} FROM event_runs")
def _(spark, sf):
    return ft.with_calendar(b.event_runs(spark, sf)).select(*IDS, *CAL_COLS)


FACT_COLS = [
    "dag_paused_flag", "dag_is_active_flag", "has_import_errors", "max_active_runs",
    "max_active_tasks", "max_consecutive_failed_dag_runs", "schedule_interval", "owners", "fileloc",
]


def facts_sql(runs):
    return f"""facts AS (SELECT t.dag_id, t.run_id, (t.at_us - p.parsed_at) / 3.6e9::DOUBLE AS dag_last_parsed_age_hours,
  CAST(p.is_paused AS INTEGER) AS dag_paused_flag,
  CASE WHEN p.dag_id IS NOT NULL THEN CAST(coalesce(p.is_active, TRUE) AS INTEGER) END AS dag_is_active_flag,
  CASE WHEN p.dag_id IS NOT NULL THEN CAST(coalesce(p.has_import_errors, FALSE) AS INTEGER) END AS has_import_errors,
  CAST(p.max_active_runs AS DOUBLE) AS max_active_runs, CAST(p.max_active_tasks AS DOUBLE) AS max_active_tasks,
  CAST(p.max_consecutive_failed_dag_runs AS DOUBLE) AS max_consecutive_failed_dag_runs,
  p.schedule_interval, p.owners, p.fileloc
 FROM {runs} t LEFT JOIN pipelines p ON p.dag_id = t.dag_id)"""


@add(
    "dimension_lookup",
    f"""WITH {s.EVENT_RUNS}, {s.PIPELINES}, {facts_sql('event_runs')}
SELECT dag_id, run_id, {q6('dag_last_parsed_age_hours')}, {', '.join(FACT_COLS)} FROM facts""",
)
def _(spark, sf):
    return ft.with_pipeline_facts(b.event_runs(spark, sf), b.customer_pipelines(spark, sf)).select(
        *IDS, *r6("dag_last_parsed_age_hours"), *FACT_COLS
    )


# What each fixed schedule means on a date d, written out by hand.
DUE_SQL = """CASE i
  WHEN 0 THEN TRUE
  WHEN 1 THEN extract('isodow' FROM d) <= 5
  WHEN 2 THEN extract('day' FROM d) = 1
  WHEN 3 THEN extract('day' FROM d) BETWEEN 10 AND 20 AND extract('month' FROM d) IN (1, 3, 5, 7, 9, 11)
  WHEN 4 THEN FALSE
  WHEN 7 THEN extract('day' FROM d) IN (1, 15) OR extract('isodow' FROM d) = 7
 END"""


@add(
    "schedule_due",
    f"""WITH c AS (SELECT c_custkey, c_custkey % 8 AS i, DATE '1995-01-01' + CAST((c_custkey * 7) % 1500 AS INTEGER) AS d FROM customer)
SELECT c_custkey, strftime(d, '%Y-%m-%d') AS day, CAST({DUE_SQL} AS INTEGER) AS due FROM c""",
)
def _(spark, sf):
    c = b.customer_pipelines(spark, sf)
    key = F.col("dag_id").cast("bigint")
    day = F.date_add(F.lit("1995-01-01").cast("date"), ((key * 7) % 1500).cast("int"))
    return c.select(
        key.alias("c_custkey"),
        F.date_format(day, "yyyy-MM-dd").alias("day"),
        schedule_due("schedule_interval", day).cast("int").alias("due"),
    )


COVERAGE_SQL = f"""day_runs AS (SELECT * FROM order_runs WHERE logical_date >= TIMESTAMP '1998-06-01' AND logical_date < TIMESTAMP '1998-06-02'),
due_pipes AS (SELECT dag_id FROM (SELECT *, CAST(dag_id AS BIGINT) % 8 AS i, DATE '1998-06-01' AS d FROM pipelines)
 WHERE coalesce(is_active, TRUE) AND NOT is_paused AND coalesce({DUE_SQL}, TRUE)),
targets AS (SELECT dag_id, run_id, at_us, logical_date, state, run_type, external_trigger, clear_number FROM day_runs
 UNION ALL SELECT DISTINCT dag_id, 'predicted_1998-06-01_' || dag_id, epoch_us(TIMESTAMP '1998-06-01'), TIMESTAMP '1998-06-01',
  NULL, 'scheduled', FALSE, NULL
 FROM due_pipes WHERE dag_id NOT IN (SELECT dag_id FROM day_runs))"""


@add(
    "coverage_expansion",
    f"""WITH {s.ORDER_RUNS}, {s.PIPELINES}, {COVERAGE_SQL}
SELECT dag_id, run_id, at_us AS logical_us, state, run_type, CAST(external_trigger AS INTEGER) AS external_trigger FROM targets""",
)
def _(spark, sf):
    t = ft.inference_targets(b.order_runs(spark, sf), b.customer_pipelines(spark, sf), TARGET_DAY)
    return t.select(
        *IDS, micros("logical_date").alias("logical_us"), "state", "run_type",
        F.col("external_trigger").cast("int").alias("external_trigger"),
    )


# --- the whole frame ------------------------------------------------------

LOG_SQL = """sig AS (SELECT dag_id, run_id, count(*) AS n,
  sum(CASE WHEN contains(message, 'Traceback (most recent cal') THEN 1 ELSE 0 END) AS st,
  sum(len(list_filter(string_split(message, chr(10)), lambda l: regexp_matches(l, 'timeout|timed out|deadline exceeded', 'i')))) AS to_n,
  sum(len(list_filter(string_split(message, chr(10)), lambda l: regexp_matches(l, 'error|exception|traceback', 'i')))) AS other_n
 FROM order_logs GROUP BY dag_id, run_id)"""
FRAME_SAMPLE = ["stacktrace_seen_rate_30d", "error_cat_timeout_30d", "error_cat_other_30d"]

FRAME_JOINS = """LEFT JOIN hist USING (dag_id, run_id) LEFT JOIN durs USING (dag_id, run_id)
 LEFT JOIN streaks USING (dag_id, run_id) LEFT JOIN task_hist USING (dag_id, run_id)
 LEFT JOIN conc USING (dag_id, run_id) LEFT JOIN pool USING (dag_id, run_id) LEFT JOIN facts USING (dag_id, run_id)
 LEFT JOIN sig USING (dag_id, run_id)"""
FRAME_COLS_SQL = f"""t.dag_id, t.run_id, t.at_us AS logical_us, t.run_type,
 {q6(*RATE_COLS)}, {', '.join(COUNT_COLS)}, {q6(*DUR_COLS)}, consecutive_failures, {q6(*TASK_COLS)}, {', '.join(PRESSURE_COLS)},
 {CALENDAR_SQL}, {q6('dag_last_parsed_age_hours')}, {', '.join(FACT_COLS)},
 round(CAST(st AS DOUBLE) / n, 6) AS stacktrace_seen_rate_30d, CAST(to_n AS DOUBLE) AS error_cat_timeout_30d,
 CAST(other_n AS DOUBLE) AS error_cat_other_30d"""


def _frame_view(frame):
    return frame.select(
        *IDS, micros("logical_date").alias("logical_us"), "run_type",
        *r6(*RATE_COLS), *COUNT_COLS, *r6(*DUR_COLS), "consecutive_failures", *r6(*TASK_COLS), *PRESSURE_COLS,
        *CAL_COLS, *r6("dag_last_parsed_age_hours"), *FACT_COLS, *r6(*FRAME_SAMPLE),
        *[c for c in ("label_failed",) if c in frame.columns],
    )


def order_signals(spark, sf):
    logs = tables.logs_of_runs(b.order_logs(spark, sf), b.order_runs(spark, sf))
    return run_log_signals(logs)


def order_frame(spark, sf):
    """Training frame over orders, line items, customers and their logs."""
    frame, _dropped = ft.training_frame(
        b.order_runs(spark, sf),
        b.order_tasks(spark, sf),
        b.customer_pipelines(spark, sf),
        order_signals(spark, sf),
        CFG,
    )
    return frame


@add(
    "feature_frame",
    f"""WITH {s.ORDER_RUNS}, {s.ORDER_TASKS}, {s.PIPELINES}, {s.ORDER_LOGS},
{history_sql('order_runs')}, {duration_sql('order_runs')}, {streak_sql('order_runs')},
{task_sql('order_runs', 'order_tasks')}, {pressure_sql('order_runs', 'order_tasks')}, {facts_sql('order_runs')}, {LOG_SQL}
SELECT {FRAME_COLS_SQL}, CASE t.state WHEN 'failed' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label_failed
FROM order_runs t {FRAME_JOINS} WHERE t.state IN ('failed', 'success')""",
)
def _(spark, sf):
    return _frame_view(order_frame(spark, sf))


def _infer_sql():
    # Targets see the full run history; each CTE is evaluated for the day's targets.
    def for_targets(cte):
        return cte.replace("FROM order_runs t ", "FROM targets t ")

    return f"""WITH {s.ORDER_RUNS}, {s.ORDER_TASKS}, {s.PIPELINES}, {s.ORDER_LOGS}, {COVERAGE_SQL},
{for_targets(history_sql('order_runs'))}, {for_targets(duration_sql('order_runs'))}, {for_targets(streak_sql('order_runs'))},
{for_targets(task_sql('order_runs', 'order_tasks'))}, {for_targets(pressure_sql('order_runs', 'order_tasks'))},
{for_targets(facts_sql('order_runs'))}, {LOG_SQL}
SELECT {FRAME_COLS_SQL} FROM targets t {FRAME_JOINS}"""


@add("inference_frame", _infer_sql())
def _(spark, sf):
    frame = ft.inference_frame(
        TARGET_DAY,
        b.order_runs(spark, sf),
        b.order_tasks(spark, sf),
        b.customer_pipelines(spark, sf),
        order_signals(spark, sf),
        CFG,
    )
    return _frame_view(frame)
