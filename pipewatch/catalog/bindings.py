"""The test tables seen as runs, tasks, pipelines, logs and artefacts.

Every binding is a projection (or one join) over a whole table; the SQL twins are in
``bindings_sql``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pipewatch.operators.timeline import micros
from pipewatch.settings import DAY, HOUR

# Twelve log texts, one per category of interest, chosen by a row's number.
MESSAGES = (
    "ImportError: No module named foo",
    "Permission denied while reading bucket",
    "Task timed out after 300 seconds",
    "Process killed: out of memory",
    "Quota exceeded, retrying with backoff",
    "Connection refused by upstream socket",
    "No such file or directory",
    "BigQuery job 42 failed",
    "KeyError: 'customer'",
    "upstream task marked as failed",
    "Traceback (most recent call last):\n  File \"x.py\", line 1\nValueError: bad value",
    "all good, nothing to see",
)
SEVERITIES = ("INFO", "warning", "ERROR", "CRITICAL")
SCHEDULES = (
    "@daily",
    "0 6 * * 1-5",
    "0 0 1 * *",
    "*/15 * 10-20 */2 *",
    "@once",
    "dataset:orders",
    None,
    "30 2 1,15 * 0",
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _ts(us: Column) -> Column:
    return F.timestamp_micros(us)


def _pick(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def event_runs(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    us = micros("ts")
    return e.select(
        F.col("user_id").cast("string").alias("dag_id"),
        F.col("event_id").cast("string").alias("run_id"),
        _ts(us).alias("logical_date"),
        F.when(F.col("event_type") == "error", "failed")
        .when(F.col("event_type") == "signup", "running")
        .otherwise("success")
        .alias("state"),
        _ts(us).alias("start_date"),
        _ts(us + F.round(F.col("value") * 1e6).cast("bigint")).alias("end_date"),
    )


def event_tasks(spark: SparkSession, sf: str) -> DataFrame:
    """One task per event, queued at the event."""
    return event_runs(spark, sf).select(
        "dag_id", "run_id", F.lit("t").alias("task_id"), F.col("logical_date").alias("queued_dttm")
    )


def order_runs(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    us = micros("o_orderdate")
    length = F.round("o_totalprice").cast("bigint") * 1_000_000
    return o.select(
        (F.col("o_custkey") % 50).cast("string").alias("dag_id"),
        F.col("o_orderkey").cast("string").alias("run_id"),
        _ts(us).alias("logical_date"),
        F.when(F.col("o_orderstatus") == "F", "failed")
        .when(F.col("o_orderstatus") == "O", "success")
        .otherwise("running")
        .alias("state"),
        _ts(us).alias("start_date"),
        F.when(F.col("o_orderkey") % 13 != 0, _ts(us + length)).alias("end_date"),
        F.lower("o_orderpriority").alias("run_type"),
        (F.col("o_orderkey") % 5 == 0).alias("external_trigger"),
        (F.col("o_orderkey") % 3).cast("int").alias("clear_number"),
    )


def order_tasks(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", micros("o_orderdate").alias("_o")
    )
    start = F.col("_o") + (F.col("l_partkey") % 120 - 40) * F.lit(DAY)
    queued = start - F.col("l_quantity").cast("bigint") * F.lit(HOUR)
    return (
        table(spark, sf, "lineitem")
        .join(o, ["l_orderkey"])
        .select(
            (F.col("o_custkey") % 50).cast("string").alias("dag_id"),
            F.col("l_orderkey").cast("string").alias("run_id"),
            F.col("l_linenumber").cast("string").alias("task_id"),
            F.when(F.col("l_returnflag") == "R", "failed")
            .when(F.col("l_returnflag") == "A", "success")
            .otherwise("skipped")
            .alias("state"),
            F.when(F.col("l_suppkey") % 13 != 0, F.col("l_linenumber")).alias("try_number"),
            F.when(F.col("l_suppkey") % 17 != 0, _ts(start)).alias("start_date"),
            F.when(F.col("l_partkey") % 11 != 0, _ts(queued)).alias("queued_dttm"),
        )
    )


def customer_pipelines(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    return c.select(
        k.cast("string").alias("dag_id"),
        (F.col("c_mktsegment") == "BUILDING").alias("is_paused"),
        F.when(k % 7 != 0, k % 10 != 0).alias("is_active"),
        _ts(F.lit(786240000000000) + k * F.lit(HOUR)).alias("last_parsed_time"),
        _pick(SCHEDULES, k % 8).alias("schedule_interval"),
        F.col("c_name").alias("fileloc"),
        F.col("c_mktsegment").alias("owners"),
        F.when(k % 9 != 0, F.col("c_acctbal") < 0).alias("has_import_errors"),
        F.col("c_nationkey").alias("max_active_runs"),
        (F.col("c_nationkey") * 2).alias("max_active_tasks"),
        F.lit(3).alias("max_consecutive_failed_dag_runs"),
    )


def event_logs(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    i = F.col("event_id")
    message = _pick(MESSAGES, i % 12)
    return e.select(
        F.col("user_id").cast("string").alias("dag_id"),
        F.concat_ws("-", F.col("user_id").cast("string"), (i % 5).cast("string")).alias("run_id"),
        F.when(i % 19 != 0, F.col("event_type")).alias("task_id"),
        (i % 4).cast("int").alias("try_number"),
        _ts(micros("ts")).alias("log_ts"),
        F.when(i % 23 != 0, _pick(SEVERITIES, i % 4)).alias("severity"),
        F.concat(F.lit("src/"), F.col("event_type"), F.lit(".py:"), i.cast("string")).alias("source_loc"),
        F.when(i % 29 != 0, message).alias("message"),
        F.when(i % 3 != 0, F.concat(F.lit("[worker] start\n  "), message, F.lit("  \n"))).alias("full_block"),
    )


def order_logs(spark: SparkSession, sf: str) -> DataFrame:
    """One log per line item, with one of the fixed texts."""
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", micros("o_orderdate").alias("_o")
    )
    message = _pick(MESSAGES, F.col("l_partkey") % 12)
    return (
        table(spark, sf, "lineitem")
        .join(o, ["l_orderkey"])
        .select(
            (F.col("o_custkey") % 50).cast("string").alias("dag_id"),
            F.col("l_orderkey").cast("string").alias("run_id"),
            F.col("l_linenumber").cast("string").alias("task_id"),
            F.col("l_linenumber").alias("try_number"),
            _ts(F.col("_o") + F.col("l_partkey") * F.lit(1_000_000)).alias("log_ts"),
            _pick(SEVERITIES, F.col("l_suppkey") % 4).alias("severity"),
            F.lit(None).cast("string").alias("source_loc"),
            message.alias("message"),
            F.lit(None).cast("string").alias("full_block"),
        )
    )


# Patterns that do occur in the test documents.
DOC_ERRORS = {
    "permission_auth": (r"auth|credential|token", r"password|secret|key"),
    "not_found": (r"not|404",),
    "timeout": (r"the .*the ",),
    "network_connection": (r"https?://|@",),
    "other": (r"error|license|copyright",),
}
DOC_KEYWORDS = {"retrying": (r"[0-9]{3}",), "killed": (r"[!?.]$",)}
DOC_STACKTRACE = r"Copyright|License"
# Added to the ids of blank logs; a multiple of 34.
BLANK_LOGS = 3_400_000_000


def document_logs(spark: SparkSession, sf: str) -> DataFrame:
    """One log per document, and a blank one beside every seventeenth."""
    d = table(spark, sf, "documents").select("doc_id", "source", "lang", "text")
    blank = d.where("doc_id % 17 = 0").select(
        (F.col("doc_id") + BLANK_LOGS).alias("doc_id"), "source", "lang", F.lit("  ").alias("text")
    )
    d, i = d.unionByName(blank), F.col("doc_id")
    return d.select(
        F.col("source").alias("dag_id"),
        F.col("lang").alias("run_id"),
        F.lit("2024-01-01").cast("timestamp").alias("logical_date"),
        F.lit("t").alias("task_id"),
        F.lit(1).alias("try_number"),
        _ts(F.lit(1704067200000000) + i * F.lit(1_000_000)).alias("log_ts"),
        F.when(i % 34 != 0, "Timeout, retrying after 429").alias("message"),
        F.col("text").alias("full_block"),
    )


def scored_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents with a made-up score; label is toxic, 11 scores are broken."""
    d = table(spark, sf, "documents").select("doc_id", "n_chars", "source", "lang")
    score = (F.col("n_chars") % 997) / F.lit(997.0)
    return (
        table(spark, sf, "labels")
        .join(d, ["doc_id"])
        .select(
            F.col("source").alias("dag_id"),
            F.col("doc_id").cast("string").alias("run_id"),
            F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")).alias("day"),
            F.col("toxic").cast("double").alias("label_failed"),
            F.col("quality").cast("double").alias("quality"),
            score.alias("predicted_failure_probability"),
            F.when(F.col("doc_id") % 5 == 0, F.lit(float("nan")))
            .when(F.col("doc_id") % 7 == 0, F.lit(float("inf")))
            .otherwise(score * 1.5)
            .alias("calibrated"),
            F.when(F.col("doc_id") % 10 == 0, F.lit(float("nan")))
            .when(F.col("doc_id") % 3 == 0, F.lit(None).cast("double"))
            .otherwise(score)
            .alias("raw"),
            F.when(F.col("doc_id") % 4 == 0, F.lit(None).cast("double"))
            .otherwise(F.col("quality").cast("double") * 2)
            .alias("hard"),
            F.concat_ws("|", F.col("lang"), _pick(DRIVERS, F.col("doc_id") % 8)).alias("top_drivers"),
        )
    )


DRIVERS = (
    "num__kw_import_error_30d",
    "num__error_cat_quota_rate_limit_30d",
    "num__avg_queue_time_7d",
    "num__error_cat_oom_memory_30d",
    "num__error_cat_network_connection_30d",
    "num__consecutive_failures",
    "num__hour_of_day",
    "cat__owners_BUILDING",
)
OBJECT_PATHS = (
    "base/outputs/failed_runs_rca_{d}.csv",
    "base/outputs/grid_cv_predictions_{d}.csv",
    "base/outputs/failed_runs_rca_report_{d}.md",
    "base/outputs/report_{d}.md",
    "base/outputs/failed_runs_rca_report_{d}.html",
    "base/artefacts/grid_cv_train_metrics.json",
    "base/outputs/other_{d}.txt",
)


def document_objects(spark: SparkSession, sf: str) -> DataFrame:
    """One stored object per document, dated by its number."""
    i = F.col("doc_id")
    day = F.date_format(F.date_add(F.lit("2026-06-01").cast("date"), (i % 31).cast("int")), "yyyyMMdd")
    return table(spark, sf, "documents").select(
        F.replace(_pick(OBJECT_PATHS, i % 7), F.lit("{d}"), day).alias("path"), "doc_id", "text"
    )


PAGE_PARENTS = ("Failed Runs RCA", "Daily Predictions", "Daily Reports", "Train Metrics", "Elsewhere")


def wiki_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Published pages: titles with dates, some rolling, some bad, some taken over."""
    i = F.col("page_id")
    day = F.date_format(F.date_add(F.lit("2026-05-20").cast("date"), (i % 40).cast("int")), "yyyy-MM-dd")
    parent = _pick(PAGE_PARENTS, i % 5)
    name = F.when(parent == "Daily Reports", "Daily Report").otherwise(parent)
    title = (
        F.when(i % 5 == 3, F.lit("Latest Train Metrics"))
        .when(i % 11 == 0, F.concat(name, F.lit(" — 2026-13-45")))
        .otherwise(F.concat(name, F.lit(" — "), day))
    )
    return table(spark, sf, "pages").select(
        i.cast("string").alias("page_id"),
        parent.alias("parent_title"),
        title.alias("title"),
        F.when(i % 6 == 0, F.col("html"))
        .otherwise(F.concat(F.lit("<!-- AUTO-GENERATED -->\n"), F.col("html")))
        .alias("body"),
    )


def artefact_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as rows of dated CSV artefacts, one per order date month."""
    o = table(spark, sf, "orders")
    return o.select(
        F.concat(F.lit("outputs/orders_"), F.date_format("o_orderdate", "yyyyMM"), F.lit(".csv")).alias("target"),
        F.concat(F.lit("Orders & more — "), F.date_format("o_orderdate", "yyyy-MM")).alias("title"),
        F.col("o_orderkey").alias("row_no"),
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.concat(F.lit("<"), F.col("o_orderpriority"), F.lit('> & "x", \'y\'')).alias("priority"),
        F.when(F.col("o_custkey") % 4 != 0, F.concat(F.lit("line1\nline "), F.col("o_custkey").cast("string"))).alias("latest_message"),
    )
