"""Daily risk report as tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from pipewatch.functions import scalars
from pipewatch.operators.cumulative import exact_quantiles, finite

PROB = "predicted_failure_probability"


def adaptive_thresholds(
    df: DataFrame, prob: str = PROB, high: float = 0.70, med: float = 0.40
) -> DataFrame:
    """One row (high, med): the configured ones, or p90 / p70 when all are below med."""
    lo, hi = min(high, med), max(high, med)
    stats = exact_quantiles(df, prob, {"p70": 0.7, "p90": 0.9, "top": 1.0})

    def clip(c: Column) -> Column:
        return F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))

    med_f = clip(F.col("p70"))
    high_f = F.greatest(med_f + F.lit(1e-6), F.least(F.col("p90"), F.lit(1.0)))
    empty, all_low = F.col("top").isNull(), F.col("top") < F.lit(lo)
    return stats.select(
        F.when(empty, F.lit(high))
        .when(all_low, high_f)
        .otherwise(F.lit(hi))
        .alias("high"),
        F.when(empty, F.lit(med))
        .when(all_low, med_f)
        .otherwise(F.lit(lo))
        .alias("med"),
    )


def with_risk(
    df: DataFrame,
    prob: str = PROB,
    high: float = 0.70,
    med: float = 0.40,
    decision: float = 0.42,
) -> DataFrame:
    """Scored rows with ``risk_bucket`` and ``predicted_fail_flag``."""
    t = adaptive_thresholds(df, prob, high, med).select(F.struct("high", "med")).scalar()
    return df.withColumn("risk_bucket", scalars.risk_bucket(prob, t["high"], t["med"])).withColumn(
        "predicted_fail_flag", scalars.fail_flag(prob, decision)
    )


def probability_summary(df: DataFrame, prob: str = PROB) -> DataFrame:
    """Rows, minimum, median, p90 and maximum of the finite probabilities."""
    q = exact_quantiles(df, prob, {"min": 0.0, "p50": 0.5, "p90": 0.9, "max": 1.0})
    n = df.agg(F.count(F.lit(1)).alias("n"))
    return q.withColumn("rows", n.scalar())


def top_rows(df: DataFrame, n: int = 10, tie_break: tuple[str, ...] = ("dag_id", "run_id")) -> DataFrame:
    """All High rows, filled up with the most likely others to ``n`` rows.

    Only the at most ``n`` fillers are ranked; the High rows need no order here.
    """
    order = [finite(PROB).desc_nulls_last(), *tie_break]
    is_high = F.coalesce(F.col("risk_bucket") == "High", F.lit(False))
    highs = df.where(is_high)
    fillers = df.where(~is_high).orderBy(*order).limit(n)
    count = highs.agg(F.count(F.lit(1)).alias("n")).scalar()
    kept = (
        fillers.withColumn("_rn", F.row_number().over(Window.orderBy(*order)))
        .where(F.col("_rn") <= F.greatest(F.lit(n) - count, F.lit(0)))
        .drop("_rn")
    )
    return highs.unionByName(kept)


def risk_counts(df: DataFrame, day: str) -> DataFrame:
    """Rows and High rows per day."""
    return df.groupBy(day).agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count(F.when(F.col("risk_bucket") == "High", 1)).alias("high_risk"),
        F.count(F.when(F.col("risk_bucket") == "Med", 1)).alias("med_risk"),
    )


def risk_trend(df: DataFrame, day: str) -> DataFrame:
    """Counts per day with the change of High against the calendar day before.

    Joined on the date, so a gap gives NULL, not the last day that had data.
    """
    counts = risk_counts(df, day)
    prev = counts.select(
        F.date_add(day, 1).alias(day), F.col("high_risk").alias("prev_high_risk")
    )
    return counts.join(prev, [day], "left").withColumn(
        "high_risk_change", F.col("high_risk") - F.col("prev_high_risk")
    )


def report_lines(rows: DataFrame) -> DataFrame:
    """Report rows with their Markdown line; pipes in cells are escaped."""

    def cell(c: Column) -> Column:
        return F.replace(scalars.cell_text(c), F.lit("|"), F.lit("\\|"))

    return rows.withColumn(
        "line",
        F.concat(
            F.lit("| "),
            F.concat_ws(
                " | ",
                cell(F.col("dag_id")),
                cell(scalars.timestamp_text("logical_date")),
                F.format_string("%.3f", F.coalesce(finite(PROB), F.lit(0.0))),
                cell(F.col("risk_bucket")),
                cell(F.col("top_drivers")),
                cell(F.col("suggested_action")),
            ),
            F.lit(" |"),
        ),
    )


def report_summary(df: DataFrame, prev: DataFrame | None, day: date) -> DataFrame:
    """One row: the three summary lines of the daily report."""
    is_high = F.count(F.when(F.col("risk_bucket") == "High", 1))
    now = df.agg(F.count(F.lit(1)).alias("total"), is_high.alias("high"))
    if prev is None:
        before = F.lit(None).cast("bigint")
    else:
        before = prev.agg(
            F.when(F.count(F.lit(1)) > 0, is_high).alias("high")
        ).scalar()
    now = now.withColumn("prev_high", before)
    change = F.col("high") - F.col("prev_high")
    signed = F.when(change >= 0, F.concat(F.lit("+"), change.cast("string"))).otherwise(
        change.cast("string")
    )
    return now.select(
        F.lit(f"# DAG Failure Risk Report — {day.isoformat()}").alias("title"),
        F.concat(F.lit("- Total runs scored: "), F.col("total").cast("string")).alias("total_line"),
        F.concat(F.lit("- High-risk runs: "), F.col("high").cast("string")).alias("high_line"),
        F.coalesce(
            F.concat(
                F.lit("- High-risk count change vs yesterday: "),
                signed,
                F.lit(" ("),
                F.col("prev_high").cast("string"),
                F.lit(" -> "),
                F.col("high").cast("string"),
                F.lit(")"),
            ),
            F.lit("- Trend vs yesterday unavailable (no previous predictions file)."),
        ).alias("trend_line"),
    )
