"""Scalar rules: labels, risk buckets, calendar, formatting, clean-up."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pipewatch.operators.cumulative import exact_quantiles, finite

# The states of a run that ended badly, ended well, or has not ended.
FAILED_RUN = ("failed", "upstream_failed", "timeout")
ENDED_WELL = ("success",)
NOT_ENDED = ("running", "queued", "scheduled")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- coercion -------------------------------------------------------------


def to_utc_timestamp(c: Column | str) -> Column:
    """Timestamp, NULL when it cannot be read as one."""
    return _col(c).try_cast("timestamp")


def to_number(c: Column | str) -> Column:
    return _col(c).try_cast("double")


def null_if_infinite(c: Column | str) -> Column:
    return finite(c)


def duration_seconds(start: Column | str, end: Column | str) -> Column:
    return (
        F.unix_micros(_col(end).cast("timestamp"))
        - F.unix_micros(_col(start).cast("timestamp"))
    ) / F.lit(1e6)


# --- states ---------------------------------------------------------------


def state_in(state: Column | str, states: Sequence[str]) -> Column:
    """Case-blind membership; NULL is no member."""
    return F.coalesce(F.lower(_col(state)).isin([s.lower() for s in states]), F.lit(False))


def failure_label(state: Column | str) -> Column:
    """1 for a run that ended badly, 0 for one that ended well, else NULL."""
    s = F.lower(F.trim(_col(state)))
    return (
        F.when(s.isin(list(FAILED_RUN)), 1.0)
        .when(s.isin(list(ENDED_WELL)), 0.0)
        .otherwise(F.lit(None).cast("double"))
    )


def is_runnable(is_active: Column | str, is_paused: Column | str) -> Column:
    """Active (unknown counts as yes) and not paused (unknown counts as no)."""
    return F.coalesce(_col(is_active).cast("boolean"), F.lit(True)) & ~F.coalesce(
        _col(is_paused).cast("boolean"), F.lit(False)
    )


# --- calendar -------------------------------------------------------------


def calendar_columns(ts: Column | str) -> dict[str, Column]:
    """Hour, weekday (Monday 0), weekend and last-two-days-of-month flags."""
    t = _col(ts).cast("timestamp")
    return {
        "hour_of_day": F.hour(t),
        "day_of_week": F.weekday(t),
        "is_weekend": (F.weekday(t) >= 5).cast("int"),
        "month_end_flag": F.coalesce(
            (F.dayofmonth(t) >= F.dayofmonth(F.last_day(t)) - 1).cast("int"), F.lit(0)
        ),
    }


def compact_date(d: Column | str) -> Column:
    return F.date_format(_col(d), "yyyyMMdd")


def iso_date(d: Column | str) -> Column:
    return F.date_format(_col(d), "yyyy-MM-dd")


def timestamp_text(ts: Column | str) -> Column:
    """``YYYY-MM-DD HH:MM:SS``, empty for NULL."""
    return F.coalesce(F.date_format(_col(ts), "yyyy-MM-dd HH:mm:ss"), F.lit(""))


# Where dates stand in file names and page titles.
FILENAME_DATE = r"_(\d{8})\."
FILENAME_ISO_DATE = r"_(\d{4}-\d{2}-\d{2})\."
TITLE_DATE = r"—\s*(\d{4}-\d{2}-\d{2})\s*$"


def _date_from(text: Column, pattern: str, fmt: str) -> Column:
    found = F.regexp_extract(text, pattern, 1)
    return F.when(found != "", F.try_to_timestamp(found, F.lit(fmt)).cast("date"))


def filename_date(path: Column | str) -> Column:
    return F.coalesce(
        _date_from(_col(path), FILENAME_DATE, "yyyyMMdd"),
        _date_from(_col(path), FILENAME_ISO_DATE, "yyyy-MM-dd"),
    )


def title_date(title: Column | str) -> Column:
    return _date_from(_col(title), TITLE_DATE, "yyyy-MM-dd")


# --- strings --------------------------------------------------------------


def expand_template(template: Column | str, d: Column | str) -> Column:
    """Fill ``{date}`` and ``{iso_date}``; without a date the text stays."""
    t = _col(template)
    return F.coalesce(
        F.replace(
            F.replace(t, F.lit("{date}"), compact_date(d)),
            F.lit("{iso_date}"),
            iso_date(d),
        ),
        t,
    )


def escape_html(c: Column | str) -> Column:
    # The five characters and their entities; "&" goes first.
    entities = [
        ("&", "&amp;"),
        ("<", "&lt;"),
        (">", "&gt;"),
        ('"', "&quot;"),
        ("'", "&#x27;"),
    ]
    return reduce(
        lambda acc, e: F.replace(acc, F.lit(e[0]), F.lit(e[1])), entities, _col(c)
    )


def cell_text(c: Column | str) -> Column:
    """A table cell: NULL and NaN are empty."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def basename(path: Column | str) -> Column:
    return F.element_at(F.split(_col(path), "/"), -1)


def state_key(target: Column | str) -> Column:
    """A key that is safe as a file name."""
    return F.translate(_col(target), "/. ", "___")


def byte_length(c: Column | str) -> Column:
    return F.octet_length(_col(c))


def redact(c: Column | str) -> Column:
    """Hide basic-auth tokens and credentials in query strings."""
    # The two patterns.
    basic = r"(?i)(Basic\s+)[A-Za-z0-9+/=]+"
    query = (
        r"(?i)([?&](?:password|os_password|auth_token|api_token|api-token)=)[^&\s]+"
    )
    out = F.regexp_replace(_col(c), basic, "$1<redacted>")
    return F.regexp_replace(out, query, "$1<redacted>")


# --- risk -----------------------------------------------------------------


def risk_bucket(prob: Column | str, high: Column, med: Column) -> Column:
    p = finite(prob)
    return (
        F.when(p.isNull(), "Unknown")
        .when(p >= high, "High")
        .when(p >= med, "Med")
        .otherwise("Low")
    )


def fail_flag(prob: Column | str, threshold: float) -> Column:
    return F.coalesce((_col(prob) > F.lit(threshold)).cast("int"), F.lit(0))


# Driver keywords and the advice for the first group that occurs.
ACTIONS: tuple[tuple[tuple[str, ...], str], ...] = (
    (
        ("import_error", "broken_dag"),
        "Validate DAG import/package dependencies and scheduler parse logs.",
    ),
    (
        ("quota", "rate_limit"),
        "Throttle concurrency, review quotas, and add backoff/retry controls.",
    ),
    (
        ("timeout", "queue"),
        "Increase timeout/worker capacity and review queue or pool saturation.",
    ),
    (
        ("oom", "memory"),
        "Increase memory resources or optimize task memory usage.",
    ),
    (
        ("network", "permission", "auth"),
        "Check IAM/credentials and network connectivity to upstream systems.",
    ),
    (
        ("consecutive_failures", "failure_rate"),
        "Escalate DAG health check, review recent failures, and verify upstream dependencies.",
    ),
)
DEFAULT_ACTION = (
    "Review latest task logs and rerun with safeguards if dependencies are healthy."
)


def suggested_action(
    drivers: Column | str,
    rules: Sequence[tuple[Sequence[str], str]] = ACTIONS,
    default: str = DEFAULT_ACTION,
) -> Column:
    """Advice of the first rule with a keyword in the joined driver names."""
    text = F.lower(F.coalesce(_col(drivers), F.lit("")))
    out = None
    for words, advice in rules:
        hit = reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])
        out = F.when(hit, advice) if out is None else out.when(hit, advice)
    return F.lit(default) if out is None else out.otherwise(default)


def clean_probabilities(
    df: DataFrame,
    calibrated: str,
    raw: str,
    hard: str,
    out: str = "predicted_failure_probability",
) -> DataFrame:
    """Calibrated, else raw, else hard 0/1, else the batch median, else 0.5; in [0, 1].

    The median is over the rows that had a finite value of their own.
    """
    h = finite(hard)
    clipped_hard = F.when(h.isNotNull(), F.least(F.greatest(h, F.lit(0.0)), F.lit(1.0)))
    own = df.withColumn("_own", F.coalesce(finite(calibrated), finite(raw), clipped_hard))
    median = exact_quantiles(own, "_own", {"m": 0.5}).select("m").scalar()
    filled = F.coalesce(F.col("_own"), median, F.lit(0.5))
    return own.withColumn(
        out, F.least(F.greatest(filled, F.lit(0.0)), F.lit(1.0))
    ).drop("_own")
