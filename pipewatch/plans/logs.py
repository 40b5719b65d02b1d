"""Log signals per run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from pipewatch.functions import text
from pipewatch.operators.ranking import top_k_per_group

RUN_KEYS = ["dag_id", "run_id", "logical_date"]
TAIL_SEPARATOR = "\n\n---\n\n"


def mined_logs(
    logs: DataFrame,
    errors: Mapping[str, Sequence[str]] = text.ERROR_PATTERNS,
    keywords: Mapping[str, Sequence[str]] = text.KEYWORD_PATTERNS,
    stacktrace: str = text.STACKTRACE_PATTERN,
    tail_lines: int = 20,
) -> DataFrame:
    """Per log record: blank flag, line counts, stack-trace flag and tail.

    The whole text is read here, before any shuffle; only the short results travel.
    """
    body = logs.withColumn("_text", text.log_text("full_block", "message")).withColumn(
        "_lines", text.split_lines("_text")
    ).withColumn("_low", text.folded("_text"))
    counts = {
        **text.line_count_columns("_lines", errors, "error_cat_", "_text", "_low"),
        **text.line_count_columns("_lines", keywords, "kw_", "_text", "_low"),
    }
    kept = [c for c in logs.columns if c not in ("full_block", "message")]
    return body.select(
        *kept,
        text.is_blank("_text").alias("is_blank"),
        text.has_stacktrace("_text", stacktrace).alias("stacktrace_seen"),
        text.tail_text("_lines", tail_lines).alias("tail"),
        *[c.alias(n) for n, c in counts.items()],
    )


def run_log_signals(
    logs: DataFrame,
    tail_lines: int = 20,
    tails_kept: int = 3,
    errors: Mapping[str, Sequence[str]] = text.ERROR_PATTERNS,
    keywords: Mapping[str, Sequence[str]] = text.KEYWORD_PATTERNS,
    stacktrace: str = text.STACKTRACE_PATTERN,
    tie_break: Sequence[str] = ("task_id", "try_number"),
) -> DataFrame:
    """One row per run: sums and rates over all its logs, and the tails of the newest ones.

    Runs with blank logs only give no row. Sums are made on the map side first and only the
    newest few tails of a run are shuffled, however many logs it has.
    """
    mined = mined_logs(logs, errors, keywords, stacktrace, tail_lines).where("NOT is_blank")
    order = [F.col("log_ts").desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tie_break]]
    names = [f"error_cat_{k}" for k in errors] + [f"kw_{k}" for k in keywords]
    sums = mined.groupBy(*RUN_KEYS).agg(
        F.count(F.lit(1)).alias("log_objects_parsed"),
        F.sum("stacktrace_seen").alias("stacktrace_seen_count"),
        *[F.sum(n).alias(n) for n in names],
    )
    newest = top_k_per_group(mined, RUN_KEYS, order, tails_kept, "_back")
    tails = [f"_tail_{i}" for i in range(tails_kept, 0, -1)]
    found = newest.groupBy(*RUN_KEYS).agg(
        *[F.max(F.when(F.col("_back") == i, F.col("tail"))).alias(f"_tail_{i}") for i in range(tails_kept, 0, -1)]
    )
    # Put together by grouping, in which NULL keys are a run of their own.
    agg = sums.unionByName(found, allowMissingColumns=True).groupBy(*RUN_KEYS).agg(
        *[F.max(c).alias(c) for c in ("log_objects_parsed", "stacktrace_seen_count")],
        F.concat_ws(TAIL_SEPARATOR, *[F.max(t) for t in tails]).alias("last_n_lines_summary"),
        *[F.max(n).alias(n) for n in names],
    )
    n = F.col("log_objects_parsed")
    return agg.select(
        *RUN_KEYS,
        "log_objects_parsed",
        "stacktrace_seen_count",
        (F.col("stacktrace_seen_count") / n).alias("stacktrace_seen_rate"),
        "last_n_lines_summary",
        *names,
        *[(F.col(c) / n).alias(f"{c}_rate") for c in names],
    )
