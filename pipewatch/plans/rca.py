"""Root causes: summaries per pipeline and per failed run, and their texts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from pipewatch.functions import scalars, text
from pipewatch.operators.ranking import latest_version, top_k_per_group
from pipewatch.sources.tables import (
    error_logs_between,
    failed_pipelines,
    newest_first,
    related_rows,
)

# The columns added to predictions and their defaults.
RCA_DEFAULTS: dict[str, str | int] = {
    "rca_error_category": "",
    "rca_top_task": "",
    "rca_top_error": "",
    "rca_stack_hint": "",
    "rca_severity": "",
    "rca_recurrence": 0,
    "rca_error_count": 0,
    "rca_try_number_max": 0,
    "rca_first_seen": "",
    "rca_last_seen": "",
}
TOP_ENTRIES = 5


def modal_task(logs: DataFrame, keys: Sequence[str], out: str = "top_task") -> DataFrame:
    """Most frequent task per group; the smallest name wins a tie.

    Rows are first counted per (group, task), on the map side too.
    """
    counts = (
        logs.where("task_id IS NOT NULL")
        .groupBy(*keys, "task_id")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return latest_version(counts, keys, [F.col("_n").desc(), "task_id"]).select(
        *keys, F.col("task_id").cast("string").alias(out)
    )


def distinct_runs(logs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct run ids per group, deduplicated before they are counted."""
    return (
        logs.where("run_id IS NOT NULL")
        .select(*keys, "run_id")
        .distinct()
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_runs"))
    )


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    r = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = c if cond is None else cond & c
    return left.join(r, cond, "left").drop(*[f"_r_{k}" for k in keys])


def rca_summary(logs: DataFrame) -> DataFrame:
    """One row per pipeline, read from its newest log and totals over all logs."""
    keys = ["dag_id"]
    known = logs.where("dag_id IS NOT NULL")
    newest = latest_version(known, keys, newest_first())
    head = newest.select(
        "dag_id",
        text.classify_error(
            F.concat_ws(
                " ",
                F.coalesce("message", F.lit("")),
                F.coalesce("full_block", F.lit("")),
            )
        ).alias("rca_error_category"),
        F.substring(F.coalesce("message", F.lit("")), 1, 200).alias("rca_top_error"),
        text.stack_hint("full_block").alias("rca_stack_hint"),
    )
    totals = known.groupBy(*keys).agg(
        text.worst_severity("severity").alias("rca_severity"),
        F.count(F.lit(1)).alias("rca_error_count"),
        F.coalesce(F.max("try_number"), F.lit(0)).cast("int").alias("rca_try_number_max"),
        scalars.timestamp_text(F.min("log_ts")).alias("rca_first_seen"),
        scalars.timestamp_text(F.max("log_ts")).alias("rca_last_seen"),
    )
    return (
        head.join(totals, keys)
        .join(modal_task(known, keys, "rca_top_task"), keys, "left")
        .join(distinct_runs(known, keys), keys, "left")
        .select(
            "dag_id",
            "rca_error_category",
            F.coalesce("rca_top_task", F.lit("")).alias("rca_top_task"),
            "rca_top_error",
            "rca_stack_hint",
            "rca_severity",
            F.coalesce("_runs", F.lit(0).cast("bigint")).alias("rca_recurrence"),
            "rca_error_count",
            "rca_try_number_max",
            "rca_first_seen",
            "rca_last_seen",
        )
    )


def rca_entries(logs: DataFrame, k: int = TOP_ENTRIES) -> DataFrame:
    """The ``k`` newest log entries per pipeline, one row each, ``rn`` from 1."""
    top = top_k_per_group(logs.where("dag_id IS NOT NULL"), ["dag_id"], newest_first(), k)

    def words(c: str, n: int | None = None, default: str = "") -> Column:
        s = F.coalesce(F.col(c).cast("string"), F.lit(default))
        return (F.substring(s, 1, n) if n else s).alias(c)

    return top.select(
        "dag_id",
        "rn",
        words("task_id"),
        F.coalesce(F.col("try_number"), F.lit(0)).alias("try_number"),
        scalars.timestamp_text("log_ts").alias("log_ts"),
        words("severity", default="UNKNOWN"),
        words("source_loc", 100),
        words("message", 200),
        text.stack_hint("full_block").alias("stack_hint"),
    )


def rca_detail(logs: DataFrame) -> DataFrame:
    """Summary plus the newest entries as a list of at most five structs."""
    entry = F.struct(
        "rn", "task_id", "try_number", "log_ts", "severity", "source_loc", "message", "stack_hint"
    )
    lists = (
        rca_entries(logs)
        .groupBy("dag_id")
        .agg(F.array_sort(F.collect_list(entry)).alias("top_entries"))
    )
    return rca_summary(logs).join(lists, ["dag_id"], "left")


def high_risk_pipelines(predictions: DataFrame) -> DataFrame:
    return predictions.where("risk_bucket = 'High'").select("dag_id").dropna().distinct()


def with_root_causes(
    predictions: DataFrame, logs: DataFrame | None, runs: DataFrame | None = None
) -> DataFrame:
    """Predictions with root-cause columns on the High pipelines, defaults elsewhere.

    With ``runs`` only pipelines that have a failed run are looked up.
    """
    base = predictions.drop(*RCA_DEFAULTS)
    if logs is None:
        return base.withColumns({c: F.lit(d) for c, d in RCA_DEFAULTS.items()})
    wanted = high_risk_pipelines(base)
    if runs is not None:
        wanted = wanted.join(failed_pipelines(runs), ["dag_id"], "left_semi")
    summaries = rca_summary(related_rows(logs, wanted, ["dag_id"]))
    joined = base.join(summaries, ["dag_id"], "left")
    return joined.withColumns(
        {c: F.coalesce(F.col(c), F.lit(d)) for c, d in RCA_DEFAULTS.items()}
    )


def root_cause_details(predictions: DataFrame, logs: DataFrame) -> DataFrame:
    """Details of all High pipelines over all their logs."""
    return rca_detail(related_rows(logs, high_risk_pipelines(predictions), ["dag_id"]))


def rca_markdown(details: DataFrame) -> DataFrame:
    """(dag_id, markdown): the report section of each pipeline."""

    def field(label: str, value: Column) -> Column:
        return F.concat(F.lit(f"| **{label}** | "), value, F.lit(" |"))

    def or_dash(c: str) -> Column:
        return F.when(F.col(c) == "", "-").otherwise(F.col(c))

    entry_lines = F.transform(
        "top_entries",
        lambda e: F.concat(
            e["rn"].cast("string"),
            F.lit(". ["),
            e["severity"],
            F.lit("] **"),
            e["task_id"],
            F.lit("** (try "),
            e["try_number"].cast("string"),
            F.lit(") "),
            e["log_ts"],
            F.lit("\n   > "),
            e["message"],
            F.when(e["stack_hint"] != "", F.concat(F.lit("\n   > _"), e["stack_hint"], F.lit("_"))).otherwise(""),
        ),
    )
    return details.select(
        "dag_id",
        F.concat_ws(
            "\n",
            F.concat(F.lit("\n### "), "dag_id"),
            F.lit("| Field | Value |"),
            F.lit("|---|---|"),
            field("Error Category", F.col("rca_error_category")),
            field("Top Failing Task", or_dash("rca_top_task")),
            field("Worst Severity", F.col("rca_severity")),
            field(
                "Recurrence",
                F.concat(F.col("rca_recurrence").cast("string"), F.lit(" distinct run(s) with errors")),
            ),
            field("Total Error Records", F.col("rca_error_count").cast("string")),
            field("Max Retry Number", F.col("rca_try_number_max").cast("string")),
            field("First Seen", or_dash("rca_first_seen")),
            field("Last Seen", or_dash("rca_last_seen")),
            field("Latest Error", F.col("rca_top_error")),
            F.when(F.col("rca_stack_hint") != "", field("Stack Hint", F.col("rca_stack_hint"))),
            F.when(F.size("top_entries") > 0, F.lit("\n**Recent error entries:**\n")),
            F.when(F.size("top_entries") > 0, F.array_join(entry_lines, "\n")),
        ).alias("markdown"),
    )


# --- failed runs ----------------------------------------------------------


def failed_run_summary(logs: DataFrame) -> DataFrame:
    """One row per (pipeline, run); NULL keys form groups of their own."""
    keys = ["dag_id", "run_id"]
    newest = latest_version(logs, keys, newest_first())
    message = F.coalesce("message", F.lit(""))
    head = newest.select(
        *keys,
        scalars.timestamp_text("log_ts").alias("latest_log_ts"),
        # Cut for display only; the category is taken from the whole text.
        F.substring(message, 1, 300).alias("latest_message"),
        text.classify_error(
            F.concat_ws(" ", message, F.coalesce("full_block", F.lit("")))
        ).alias("error_category"),
        text.stack_hint("full_block").alias("stack_hint"),
    )
    totals = logs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("log_count"),
        F.coalesce(F.max("try_number"), F.lit(0)).cast("int").alias("max_try_number"),
        text.worst_severity("severity").alias("worst_severity"),
    )
    out = _null_safe_join(head, totals, keys)
    out = _null_safe_join(out, modal_task(logs, keys, "top_failing_task"), keys)
    return out.select(
        "dag_id",
        "run_id",
        "log_count",
        F.coalesce("top_failing_task", F.lit("")).alias("top_failing_task"),
        "max_try_number",
        "worst_severity",
        "latest_log_ts",
        "latest_message",
        "error_category",
        "stack_hint",
    )


def failed_run_order(alphabetical: bool = False) -> list[Column]:
    """Worst severity, most logs, newest first; by rank unless told otherwise."""
    first = F.col("worst_severity") if alphabetical else text.severity_rank("worst_severity")
    return [
        first.desc(),
        F.col("log_count").desc(),
        F.col("latest_log_ts").desc(),
        F.col("dag_id"),
        F.col("run_id"),
    ]


def failed_run_report(
    logs: DataFrame, day: date, lookback_days: int = 7, newest: int | None = None
) -> DataFrame:
    """Failed-run summary of the days up to and with ``day``, worst first."""
    end = datetime(day.year, day.month, day.day) + timedelta(days=1)
    severe = error_logs_between(logs, end - timedelta(days=lookback_days), end, newest=newest)
    return failed_run_summary(severe).orderBy(*failed_run_order())


def failed_run_lines(summary: DataFrame) -> DataFrame:
    """Summary rows with their Markdown table line."""
    cells = [
        "dag_id", "run_id", "worst_severity", "log_count", "top_failing_task",
        "max_try_number", "error_category", "latest_message",
    ]
    return summary.withColumn(
        "line",
        F.concat(
            F.lit("| "),
            F.concat_ws(
                " | ",
                *[
                    F.replace(scalars.cell_text(c), F.lit("|"), F.lit(""))
                    for c in cells
                ],
            ),
            F.lit(" |"),
        ),
    )
