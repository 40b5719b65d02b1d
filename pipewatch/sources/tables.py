"""Scans of the input tables: versions, date ranges, related rows, logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pipewatch.operators.ranking import latest_version, top_k_per_group
from pipewatch.schemas import SCHEMAS, VERSION_COLUMN, VERSION_KEYS, conform


def read_table(
    spark: SparkSession, name: str, locations: Mapping[str, str]
) -> DataFrame:
    """The table behind ``name``: a catalog table or a parquet path.

    A name without a location, or a location that does not exist, gives an empty
    table with the schema of that name.
    """
    where = locations.get(name)
    if where is not None:
        try:
            if "/" in where:
                return spark.read.parquet(where)
            return spark.read.table(where)
        except AnalysisException as exc:
            if exc.getCondition() not in (
                "PATH_NOT_FOUND",
                "TABLE_OR_VIEW_NOT_FOUND",
                "UNABLE_TO_INFER_SCHEMA",
            ):
                raise
    return spark.createDataFrame([], SCHEMAS[name])


def latest_scan(
    df: DataFrame,
    name: str,
    where: Column | None = None,
    tie_break: Sequence[Column | str] = (),
) -> DataFrame:
    """Filter, keep the newest version per key, conform to the table's schema.

    The filter comes first: a row whose newest version fails it can still appear in
    an older version that passes.
    """
    if where is not None:
        df = df.where(where)
    keys = [k for k in VERSION_KEYS.get(name, ()) if k in df.columns]
    if keys:
        rest = sorted(set(df.columns) - set(keys) - {VERSION_COLUMN})
        order = [F.col(VERSION_COLUMN).desc_nulls_last()] if VERSION_COLUMN in df.columns else []
        order += list(tie_break) or [F.col(c).desc_nulls_last() for c in rest]
        df = latest_version(df, keys, order)
    return conform(df, SCHEMAS[name])


def date_range(column: str, start: date | None, end: date | None) -> Column:
    """``[start, end + 1 day)``; an open side is no bound."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(column) >= F.lit(datetime(start.year, start.month, start.day)))
    if end is not None:
        after = datetime(end.year, end.month, end.day) + timedelta(days=1)
        cond = cond & (F.col(column) < F.lit(after))
    return cond


def related_rows(df: DataFrame, keys_from: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose keys occur in ``keys_from``."""
    wanted = keys_from.select(*keys).dropna().distinct()
    return df.join(wanted, list(keys), "left_semi")


def scan_metadata(
    runs: DataFrame,
    tasks: DataFrame,
    pipelines: DataFrame,
    start: date | None = None,
    end: date | None = None,
) -> dict[str, DataFrame]:
    """Runs of a date range, and the tasks and pipelines that belong to them."""
    r = latest_scan(runs, "runs", date_range("execution_date", start, end)).withColumn(
        "logical_date", F.col("execution_date")
    )
    return {
        "runs": r,
        "tasks": latest_scan(related_rows(tasks, r, ["dag_id"]), "tasks"),
        "pipelines": latest_scan(related_rows(pipelines, r, ["dag_id"]), "pipelines"),
    }


# --- logs -----------------------------------------------------------------


def logs_of_runs(logs: DataFrame, runs: DataFrame, margin_days: int = 2) -> DataFrame:
    """Logs of the given runs with their logical date.

    Only logs within ``margin_days`` of the runs' dates are read, when there is any
    date at all.
    """
    keys = (
        runs.select("dag_id", "run_id", "logical_date")
        .dropna(subset=["dag_id", "run_id"])
        .distinct()
    )
    span = keys.agg(
        F.struct(
            (F.min("logical_date") - F.make_dt_interval(F.lit(margin_days))).alias("lo"),
            (F.max("logical_date") + F.make_dt_interval(F.lit(margin_days))).alias("hi"),
        ).alias("s")
    ).scalar()
    near = F.col("log_ts").between(span["lo"], span["hi"])
    return logs.where(near | span["lo"].isNull()).join(keys, ["dag_id", "run_id"])


def newest_first() -> list[Column]:
    """Newest log first; the other columns settle ties."""
    return [
        F.col("log_ts").desc_nulls_last(),
        F.col("run_id").desc_nulls_last(),
        F.col("task_id").asc_nulls_last(),
        F.col("try_number").desc_nulls_last(),
        F.col("message").asc_nulls_last(),
    ]


def logs_of_pipelines(
    logs: DataFrame,
    pipelines: DataFrame,
    per_pipeline: int | None = None,
) -> DataFrame:
    """All logs of the given pipelines; ``per_pipeline`` keeps only the newest rows of each."""
    out = related_rows(logs, pipelines, ["dag_id"])
    if per_pipeline is not None:
        out = top_k_per_group(out, ["dag_id"], newest_first(), per_pipeline, "_rn").drop("_rn")
    return out


def failed_pipelines(
    runs: DataFrame, states: Sequence[str] = ("failed", "upstream_failed", "timeout")
) -> DataFrame:
    """Pipelines with a run in one of the states, spelled exactly so."""
    return runs.where(F.col("state").isin(list(states))).select("dag_id").dropna().distinct()


def error_logs_between(
    logs: DataFrame,
    start: datetime,
    end: datetime,
    severities: Sequence[str] = ("ERROR", "CRITICAL"),
    newest: int | None = None,
) -> DataFrame:
    """Severe logs strictly between two instants; optionally only the newest."""
    out = logs.where(
        (F.col("log_ts") > F.lit(start))
        & (F.col("log_ts") < F.lit(end))
        & F.upper(F.coalesce("severity", F.lit(""))).isin(list(severities))
    )
    return out if newest is None else out.orderBy(*newest_first()).limit(newest)
