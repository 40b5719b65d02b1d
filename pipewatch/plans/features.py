"""The point-in-time feature frame: what was known before each run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from pipewatch.functions import scalars
from pipewatch.functions.schedule import schedule_due
from pipewatch.functions.text import ERROR_PATTERNS, KEYWORD_PATTERNS
from pipewatch.operators.ranking import latest_version
from pipewatch.operators.timeline import (
    micros,
    span_deltas,
    strict_prefix_sums,
    trailing_quantile,
    trailing_streaks,
)
from pipewatch.session import durable
from pipewatch.settings import DAY, HOUR

KEYS = ["dag_id", "run_id", "logical_date"]
WIDE = "decimal(38,0)"
# The states of a task that count as failed, in general and for critical tasks.
FAILED_TASK = ("failed", "upstream_failed", "skipped")
FAILED_CRITICAL = ("failed", "upstream_failed")


@dataclass(frozen=True)
class FramePlan:
    """How far back a target's features look, and the tasks that are watched closely."""

    windows: tuple[int, ...] = (7, 30, 90)
    pressure_hours: int = 1
    critical_tasks: tuple[str, ...] = ()


# --- targets --------------------------------------------------------------


def tag_targets(runs: DataFrame) -> DataFrame:
    """Runs with ``label_failed`` and ``target_kind``: kept, excluded or unlabelled."""
    label = scalars.failure_label("state")
    return runs.withColumn("label_failed", label).withColumn(
        "target_kind",
        F.when(scalars.state_in("state", scalars.NOT_ENDED), "excluded")
        .when(F.col("label_failed").isNull(), "unlabelled")
        .otherwise("kept"),
    )


def training_targets(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped) targets; dropped are the excluded and the unlabelled ones."""
    tagged = tag_targets(runs)
    kept = tagged.where("target_kind = 'kept'").drop("target_kind")
    dropped = tagged.where("target_kind <> 'kept'").drop("target_kind")
    return kept, dropped


def day_targets(runs: DataFrame, day: date) -> DataFrame:
    lo = datetime(day.year, day.month, day.day)
    return runs.where(
        (F.col("logical_date") >= F.lit(lo))
        & (F.col("logical_date") < F.lit(lo + timedelta(days=1)))
    )


def expected_targets(pipelines: DataFrame, day: date) -> DataFrame:
    """One synthetic target per runnable pipeline that is, or may be, due that day."""
    lo = datetime(day.year, day.month, day.day)
    due = schedule_due("schedule_interval", F.lit(day))
    return (
        pipelines.where(scalars.is_runnable("is_active", "is_paused"))
        .where(F.coalesce(due, F.lit(True)))
        .select("dag_id")
        .distinct()
        .select(
            "dag_id",
            F.concat(F.lit(f"predicted_{day.isoformat()}_"), "dag_id").alias("run_id"),
            F.lit(lo).alias("logical_date"),
            F.lit(None).cast("string").alias("state"),
            F.lit("scheduled").alias("run_type"),
            F.lit(False).alias("external_trigger"),
        )
    )


def inference_targets(runs: DataFrame, pipelines: DataFrame, day: date) -> DataFrame:
    """The day's runs, plus expected targets of pipelines without one."""
    real = day_targets(runs, day)
    missing = expected_targets(pipelines, day).join(
        real.select("dag_id").dropna().distinct(), ["dag_id"], "left_anti"
    )
    return real.unionByName(missing, allowMissingColumns=True)


# --- history --------------------------------------------------------------


def _us(days: int) -> Column:
    return F.lit(days * DAY)


def _with_micros(runs: DataFrame) -> DataFrame:
    return runs.withColumn("at", micros("logical_date"))


def duration_micros(runs: DataFrame) -> Column:
    """End minus start; where unknown, an optional ``duration`` column in seconds."""
    span = micros("end_date") - micros("start_date")
    if "duration" in runs.columns:
        return F.coalesce(
            span, F.round(F.col("duration").cast("double") * 1e6).cast("bigint")
        )
    return span


def history_deltas(runs: DataFrame, cfg: FramePlan) -> DataFrame:
    """Signed rows of run counts, failures and durations for every window.

    A run opens all its windows at once and closes each at its own time, so one
    scan writes one row per run and window plus one.
    """
    base = _with_micros(runs).select(
        "dag_id",
        "at",
        scalars.state_in("state", scalars.FAILED_RUN).cast("bigint").alias("_f"),
        duration_micros(runs).alias("_d"),
    )
    edges = ", ".join(f"struct({w} AS _w, {w * DAY}L AS _shift)" for w in (0, *cfg.windows))

    def signed(value: str, w: int, name: str, kind: str = "bigint") -> str:
        v = f"CAST({value} AS {kind})"
        return f"CASE WHEN _w = 0 THEN {v} WHEN _w = {w} THEN -{v} END AS {name}"

    cols = []
    for w in cfg.windows:
        cols += [signed("1", w, f"_n{w}"), signed("_f", w, f"_f{w}")]
    if 30 in cfg.windows:
        d = "CAST(_d AS decimal(19,0))"
        cols += [
            signed("CASE WHEN _d IS NOT NULL THEN 1 END", 30, "_dn"),
            signed(d, 30, "_ds", "decimal(28,0)"),
            signed(f"{d} * {d}", 30, "_dq", WIDE),
        ]
    return base.selectExpr("*", f"inline(array({edges}))").selectExpr(
        "dag_id", "at + _shift AS at", *cols
    )


def task_deltas(tasks: DataFrame, runs: DataFrame, cfg: FramePlan) -> DataFrame:
    """Signed rows of task outcomes.

    A target sees a task when the task's run is earlier and the task's own time is
    at most 30 days (queue times: 7 days) before the target.
    """
    run_times = (
        _with_micros(runs)
        .where("at IS NOT NULL AND run_id IS NOT NULL")
        .groupBy("dag_id", "run_id")
        .agg(F.min("at").alias("_run"))
    )
    base = tasks.join(run_times, ["dag_id", "run_id"]).select(
        "dag_id",
        "_run",
        micros("queued_dttm").alias("_q"),
        micros("start_date").alias("_s"),
        F.coalesce(F.col("try_number").cast("bigint"), F.lit(0)).alias("_try"),
        scalars.state_in("state", FAILED_TASK).cast("bigint").alias("_bad"),
        F.coalesce(
            F.col("task_id").cast("string").isin(list(cfg.critical_tasks)), F.lit(False)
        ).alias("_crit")
        if cfg.critical_tasks
        else F.lit(False).alias("_crit"),
        scalars.state_in("state", FAILED_CRITICAL).alias("_critbad"),
    )
    # One scan: each task opens both windows at its run and leaves each at its own time.
    windows = base.selectExpr(
        "*",
        f"coalesce(coalesce(_s, _q) + {30 * DAY}L > _run, false) AS _in_t",
        f"coalesce(_q + {7 * DAY}L > _run, false) AS _in_q",
    )
    edges = (
        "inline(array(struct(0 AS _edge, _run AS at),"
        f" struct(30 AS _edge, coalesce(_s, _q) + {30 * DAY}L AS at),"
        f" struct(7 AS _edge, _q + {7 * DAY}L AS at)))"
    )
    signed = windows.selectExpr("*", edges).where(
        "CASE _edge WHEN 0 THEN _in_t OR _in_q WHEN 30 THEN _in_t ELSE _in_q END"
    )

    def value(text: str, edge: int, name: str, kind: str = "bigint") -> str:
        inside = "_in_t" if edge == 30 else "_in_q"
        v = f"CAST({text} AS {kind})"
        return f"CASE WHEN _edge = {edge} THEN -{v} WHEN _edge = 0 AND {inside} THEN {v} END AS {name}"

    return signed.selectExpr(
        "dag_id",
        "at",
        value("1", 30, "_tn"),
        value("_try - 1", 30, "_retries"),
        value("IF(_try > 1, 1, 0)", 30, "_retried"),
        value("_bad", 30, "_bad"),
        value("IF(_crit, 1, 0)", 30, "_cn"),
        value("IF(_crit AND _critbad, 1, 0)", 30, "_cbad"),
        value("IF(_s IS NOT NULL, 1, NULL)", 7, "_qn"),
        value("_s - _q", 7, "_qs", "decimal(28,0)"),
    )


HISTORY_SUMS_30 = ["_dn", "_ds", "_dq"]
TASK_SUMS = ["_tn", "_retries", "_retried", "_bad", "_cn", "_cbad", "_qn", "_qs"]


def _rate(part: Column, whole: Column) -> Column:
    """NULL when there is nothing to divide by, absent rows included."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double"))


def history_columns(cfg: FramePlan) -> dict[str, Column]:
    out = {}
    for w in cfg.windows:
        n = F.coalesce(F.col(f"_n{w}"), F.lit(0).cast("bigint"))
        out[f"failure_rate_{w}d"] = _rate(F.col(f"_f{w}"), n)
        out[f"runs_count_{w}d"] = n
    return out


def duration_columns() -> dict[str, Column]:
    n = F.col("_dn")
    some = n > 0
    # Exact decimals: the difference of two large sums would lose digits as doubles.
    mean = (
        F.col("_ds").try_cast("decimal(24,0)") / n.cast("decimal(12,0)")
    ).try_cast("decimal(26,12)")
    square = (
        F.col("_dq").try_cast("decimal(30,0)") / n.cast("decimal(12,0)")
    ).try_cast("decimal(38,8)")
    rough_mean = F.col("_ds").cast("double") / n
    variance = F.coalesce(
        (square - (mean * mean).try_cast("decimal(38,8)")).cast("double"),
        F.col("_dq").cast("double") / n - rough_mean * rough_mean,
    )
    return {
        "mean_duration_30d": F.when(some, F.col("_ds").cast("double") / n / 1e6),
        "duration_std_30d": F.when(
            some, F.sqrt(F.greatest(variance, F.lit(0.0))) / 1e6
        ),
    }


def task_columns(cfg: FramePlan) -> dict[str, Column]:
    n = F.col("_tn")
    return {
        "avg_retries_30d": _rate(F.col("_retries"), n),
        "retry_rate_30d": _rate(F.col("_retried"), n),
        "failed_tasks_rate_30d": _rate(F.col("_bad"), n),
        "critical_tasks_failed_rate_30d": _rate(F.col("_cbad"), F.col("_cn")),
        "avg_queue_time_7d": F.when(
            F.col("_qn") > 0, F.col("_qs").cast("double") / F.col("_qn") / 1e6
        ),
    }


def _instants(targets: DataFrame, keys: list[str]) -> DataFrame:
    # Repeated instants are merged where the targets meet the events.
    return _with_micros(targets).select(*keys, "at").dropna()


def _attach(targets: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    return _with_micros(targets).join(found, [*keys, "at"], "left")


def with_history(targets: DataFrame, runs: DataFrame, cfg: FramePlan) -> DataFrame:
    """Targets with failure rates and run counts per window."""
    deltas = history_deltas(runs, cfg)
    sums = [f"_{k}{w}" for w in cfg.windows for k in "nf"]
    found = strict_prefix_sums(
        deltas.select("dag_id", "at", *sums), _instants(targets, ["dag_id"]), ["dag_id"], sums
    )
    out = _attach(targets, found, ["dag_id"]).withColumns(history_columns(cfg))
    return out.drop("at", *sums)


def with_durations(targets: DataFrame, runs: DataFrame, cfg: FramePlan) -> DataFrame:
    """Targets with mean, 95th percentile and spread of durations over 30 days."""
    found = strict_prefix_sums(
        history_deltas(runs, cfg).select("dag_id", "at", *HISTORY_SUMS_30),
        _instants(targets, ["dag_id"]),
        ["dag_id"],
        HISTORY_SUMS_30,
    )
    out = _attach(targets, found, ["dag_id"]).withColumns(duration_columns())
    p95 = _p95(targets, runs)
    return (
        out.join(p95, ["dag_id", "at"], "left").drop("at", *HISTORY_SUMS_30)
    )


def _p95(targets: DataFrame, runs: DataFrame) -> DataFrame:
    found = trailing_quantile(
        _with_micros(runs).withColumn("_d", duration_micros(runs)),
        _instants(targets, ["dag_id"]),
        ["dag_id"],
        "_d",
        0.95,
        30 * DAY,
    )
    return found.select("dag_id", "at", (F.col("quantile") / 1e6).alias("p95_duration_30d"))


def _streaks(targets: DataFrame, runs: DataFrame, cfg: FramePlan) -> DataFrame:
    return trailing_streaks(
        _with_micros(runs).withColumn("_failed", scalars.state_in("state", scalars.FAILED_RUN)),
        _instants(targets, ["dag_id"]),
        ["dag_id"],
        "run_id",
        "_failed",
    ).select("dag_id", "at", F.col("streak").alias("consecutive_failures"))


def with_streaks(targets: DataFrame, runs: DataFrame, cfg: FramePlan) -> DataFrame:
    """Targets with the number of failures in a row right before them."""
    out = _attach(targets, _streaks(targets, runs, cfg), ["dag_id"])
    return out.withColumn(
        "consecutive_failures", F.coalesce("consecutive_failures", F.lit(0).cast("bigint"))
    ).drop("at")


def with_task_history(
    targets: DataFrame, tasks: DataFrame, runs: DataFrame, cfg: FramePlan
) -> DataFrame:
    """Targets with retry, task-failure and queue-time features."""
    found = strict_prefix_sums(
        task_deltas(tasks, runs, cfg), _instants(targets, ["dag_id"]), ["dag_id"], TASK_SUMS
    )
    return (
        _attach(targets, found, ["dag_id"])
        .withColumns(task_columns(cfg))
        .drop("at", *TASK_SUMS)
    )


def pressure_deltas(tasks: DataFrame, runs: DataFrame, cfg: FramePlan) -> DataFrame:
    """Signed rows over all pipelines: running runs nearby, tasks queued before.

    Bounds are inclusive, hence the shift of one microsecond at the opening.
    """
    reach = cfg.pressure_hours * HOUR
    one = F.lit(1).cast("bigint")
    running = span_deltas(
        _with_micros(runs).where(F.lower("state") == "running"),
        [],
        F.col("at") - F.lit(reach + 1),
        F.col("at") + F.lit(reach),
        {"_run": one},
    )
    edges = (
        "inline(array(struct(_q - 1 AS at, 1L AS _h1, 1L AS _h24),"
        f" struct(_q + {HOUR}L AS at, -1L AS _h1, 0L AS _h24),"
        f" struct(_q + {24 * HOUR}L AS at, 0L AS _h1, -1L AS _h24)))"
    )
    queued = (
        tasks.select(micros("queued_dttm").alias("_q")).where("_q IS NOT NULL").selectExpr(edges)
    )
    return running.unionByName(queued, allowMissingColumns=True)


PRESSURE = {
    "_run": "concurrent_runs_proxy",
    "_h1": "pool_pressure_proxy_1h",
    "_h24": "pool_pressure_proxy_24h",
}


def with_pressure(
    targets: DataFrame, tasks: DataFrame, runs: DataFrame, cfg: FramePlan
) -> DataFrame:
    """Targets with how busy the whole system was around them."""
    found = strict_prefix_sums(
        pressure_deltas(tasks, runs, cfg), _instants(targets, []), [], list(PRESSURE)
    )
    out = _attach(targets, found, [])
    return out.withColumns(
        {
            name: F.coalesce(F.col(c), F.lit(0).cast("bigint"))
            for c, name in PRESSURE.items()
        }
    ).drop("at", *PRESSURE)


def with_calendar(targets: DataFrame) -> DataFrame:
    return targets.withColumns(scalars.calendar_columns("logical_date"))


def with_pipeline_facts(targets: DataFrame, pipelines: DataFrame) -> DataFrame:
    """Targets with columns of their pipeline; all NULL when it is unknown."""
    order = [F.col("last_parsed_time").desc_nulls_last()] + [
        F.col(c).desc_nulls_last() for c in ("schedule_interval", "owners", "fileloc")
    ]
    flags = {
        "dag_paused_flag": ("is_paused", False),
        "dag_is_active_flag": ("is_active", True),
        "has_import_errors": ("has_import_errors", False),
    }
    facts = latest_version(pipelines.where("dag_id IS NOT NULL"), ["dag_id"], order).select(
        "dag_id",
        micros("last_parsed_time").alias("_parsed"),
        *[
            F.coalesce(F.col(c).cast("boolean"), F.lit(d)).cast("int").alias(n)
            for n, (c, d) in flags.items()
        ],
        *[
            F.col(c).cast("double").alias(c)
            for c in ("max_active_runs", "max_active_tasks", "max_consecutive_failed_dag_runs")
        ],
        "schedule_interval",
        "owners",
        "fileloc",
    )
    return (
        targets.join(facts, ["dag_id"], "left")
        .withColumn(
            "dag_last_parsed_age_hours",
            (micros("logical_date") - F.col("_parsed")) / F.lit(3.6e9),
        )
        .drop("_parsed")
    )


LOG_FEATURES = [f"error_cat_{k}" for k in ERROR_PATTERNS] + [f"kw_{k}" for k in KEYWORD_PATTERNS]


def with_log_signals(targets: DataFrame, signals: DataFrame | None) -> DataFrame:
    """Targets with the log signals of the same run.

    The column names end in ``_30d`` like the other features, but they describe the
    target run's own logs, which exist only once it has run: see ``LEAKY_COLUMNS``.
    """
    if signals is None:
        return targets.withColumns(
            {
                f"{c}_30d": F.lit(None).cast("double")
                for c in ["stacktrace_seen_rate", *LOG_FEATURES]
            }
        )
    s = signals.select(
        *KEYS,
        F.col("stacktrace_seen_rate").alias("stacktrace_seen_rate_30d"),
        *[F.col(c).cast("double").alias(f"{c}_30d") for c in LOG_FEATURES],
    )
    return targets.join(s, KEYS, "left")


LEAKY_COLUMNS = [f"{c}_30d" for c in ["stacktrace_seen_rate", *LOG_FEATURES]]

# Order of the feature frame.
FRAME_COLUMNS = (
    KEYS
    + ["run_type", "external_trigger", "clear_number"]
    + [f"{n}_{w}d" for w in (7, 30, 90) for n in ("failure_rate", "runs_count")]
    + ["mean_duration_30d", "p95_duration_30d", "duration_std_30d", "consecutive_failures"]
    + ["avg_retries_30d", "retry_rate_30d", "failed_tasks_rate_30d"]
    + ["critical_tasks_failed_rate_30d", "avg_queue_time_7d", "concurrent_runs_proxy"]
    + ["pool_pressure_proxy_1h", "pool_pressure_proxy_24h"]
    + ["hour_of_day", "day_of_week", "is_weekend", "month_end_flag"]
    + ["dag_last_parsed_age_hours", "dag_paused_flag", "dag_is_active_flag"]
    + ["has_import_errors", "max_active_runs", "max_active_tasks"]
    + ["max_consecutive_failed_dag_runs", "schedule_interval", "owners", "fileloc"]
    + LEAKY_COLUMNS
)


def feature_frame(
    targets: DataFrame,
    runs: DataFrame,
    tasks: DataFrame,
    pipelines: DataFrame,
    signals: DataFrame | None,
    cfg: FramePlan,
) -> DataFrame:
    """All features of the targets.

    History and task sums share one running-sum pass; streak, quantile and pressure
    have their own. All meet the targets on (pipeline, instant).
    """
    at_keys = ["dag_id", "at"]
    sums = [f"_{k}{w}" for w in cfg.windows for k in "nf"] + HISTORY_SUMS_30 + TASK_SUMS
    deltas = history_deltas(runs, cfg).unionByName(
        task_deltas(tasks, runs, cfg), allowMissingColumns=True
    )
    instants = _instants(targets, ["dag_id"])
    sums_found = strict_prefix_sums(deltas, instants, ["dag_id"], sums)
    per_pipeline = sums_found.join(_streaks(targets, runs, cfg), at_keys, "left").join(
        _p95(targets, runs), at_keys, "left"
    )
    out = _attach(targets, per_pipeline, ["dag_id"])
    out = out.withColumns(
        {**history_columns(cfg), **duration_columns(), **task_columns(cfg)}
    ).withColumn(
        "consecutive_failures",
        F.coalesce("consecutive_failures", F.lit(0).cast("bigint")),
    ).drop("at", *sums)
    out = with_pressure(out, tasks, runs, cfg)
    out = with_pipeline_facts(with_calendar(out), pipelines)
    out = with_log_signals(out, signals)
    extra = [c for c in ("label_failed", "state") if c in out.columns]
    absent = [c for c in FRAME_COLUMNS if c not in out.columns]
    out = out.withColumns({c: F.lit(None).cast("string") for c in absent})
    windows = [f"{n}_{w}d" for w in cfg.windows if w not in (7, 30, 90) for n in ("failure_rate", "runs_count")]
    return out.select(*FRAME_COLUMNS, *windows, *extra)


def training_frame(
    runs: DataFrame,
    tasks: DataFrame,
    pipelines: DataFrame,
    signals: DataFrame | None,
    cfg: FramePlan,
    start: date | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(feature frame of the labelled runs, dropped targets).

    ``start`` limits the targets; earlier runs still count as their history.
    """
    kept, dropped = training_targets(runs)
    if start is not None:
        recent = F.col("logical_date") >= F.lit(datetime(start.year, start.month, start.day))
        kept, dropped = kept.where(recent), dropped.where(recent)
    return feature_frame(kept, runs, tasks, pipelines, signals, cfg), dropped


def inference_frame(
    day: date,
    runs: DataFrame,
    tasks: DataFrame,
    pipelines: DataFrame,
    signals: DataFrame | None,
    cfg: FramePlan,
) -> DataFrame:
    """Feature frame of the day's runs and of the pipelines expected that day."""
    # A day's targets are few and every feature family asks for them: find them once.
    targets = durable(inference_targets(runs, pipelines, day))
    return feature_frame(targets, runs, tasks, pipelines, signals, cfg)
