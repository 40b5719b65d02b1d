"""Whole batch jobs: tables in, tables out, at paths of any Hadoop file system."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from pipewatch.ml import explain, fit, score
from pipewatch.operators.ranking import with_group_index
from pipewatch.plans import features, publish, rca, report
from pipewatch.plans.logs import run_log_signals
from pipewatch.session import durable
from pipewatch.settings import PublishSettings
from pipewatch.sources import artefacts, tables
from pyspark.sql.types import StructType


def _load(spark: SparkSession, locations: Mapping[str, str]) -> dict[str, DataFrame]:
    return {n: tables.read_table(spark, n, locations) for n in ("runs", "tasks", "pipelines", "logs")}


def _signals(logs: DataFrame, runs: DataFrame, with_logs: bool) -> DataFrame | None:
    return run_log_signals(tables.logs_of_runs(logs, runs)) if with_logs else None


def train_job(
    spark: SparkSession,
    locations: Mapping[str, str],
    out: str,
    day: date,
    back_days: int = 30,
    plan: features.FramePlan = features.FramePlan(),
    with_logs: bool = True,
    include_leaky: bool = False,
    **search,
) -> fit.ModelBundle:
    """Train on the runs of the last ``back_days`` (``search`` goes to ``fit.train``) and store model, metrics, features.

    Runs from before that serve as history only, so that the longest window of the
    first targets is full.
    """
    raw = _load(spark, locations)
    start = day - timedelta(days=back_days)
    look_back = max((*plan.windows, 0))
    meta = tables.scan_metadata(
        raw["runs"], raw["tasks"], raw["pipelines"], start - timedelta(days=look_back), day
    )
    runs = meta["runs"]
    frame, _dropped = features.training_frame(
        runs, meta["tasks"], meta["pipelines"], _signals(raw["logs"], runs, with_logs), plan, start
    )
    path = f"{out}/artefacts/training_features"
    artefacts.write_table(frame, path)
    stored = spark.read.parquet(path)
    if not stored.take(1):
        raise RuntimeError("the feature frame is empty, there is nothing to train on")
    names = fit.feature_columns(stored, include_leaky)
    bundle, scored = fit.train(stored, names, **search)
    bundle.save(f"{out}/artefacts/model")

    importance = explain.permutation_importance(
        scored.where("split = 'test'"), bundle.model, bundle.preprocessor.slot_table(), seed=search.get("seed", fit.SEED)
    )
    artefacts.write_table(importance, f"{out}/artefacts/feature_importance", "csv")
    artefacts.write_artefact(importance, out, IMPORTANCE, [F.desc("importance_mean"), "feature"])
    by_split = fit.training_metrics(bundle, scored)
    artefacts.write_table(by_split, f"{out}/artefacts/train_metrics_csv", "csv")
    # One short JSON document, as the metrics of three splits and fifteen features.
    document = {
        "threshold": bundle.threshold,
        "threshold_source": "validation_f1_optimal",
        "model_type": bundle.model_type,
        "params": bundle.params,
        "top_global_features": [
            {"feature": r["feature"], "importance": r["importance_mean"]}
            for r in explain.top_features(spark.read.option("header", True).schema(
                "feature string, importance_mean double, importance_std double"
            ).csv(f"{out}/artefacts/feature_importance")).collect()
        ],
    }
    for r in by_split.collect():
        values = r.asDict()
        name = values.pop("split")
        document.update({f"{name}_{k}": v for k, v in values.items()})
    text = spark.createDataFrame([(json.dumps(document, indent=2),)], "value string").coalesce(1)
    text.write.mode("overwrite").text(f"{out}/artefacts/train_metrics")
    artefacts.write_artefact(text, out, METRICS, ["value"], "json")
    return bundle


PREDICTIONS = "predictions"
# The paths that discovery looks for, by the order of the kinds.
FAILED, PREDICTED, FAILED_REPORT, REPORT, METRICS, IMPORTANCE = (kind[0] for kind in publish.KINDS)


def predict_job(
    spark: SparkSession,
    locations: Mapping[str, str],
    out: str,
    day: date,
    plan: features.FramePlan = features.FramePlan(),
    with_logs: bool = True,
    **thresholds,
) -> DataFrame:
    """Score a day's runs and expected pipelines; replace that day's predictions."""
    bundle = fit.ModelBundle.load(spark, f"{out}/artefacts/model")
    raw = _load(spark, locations)
    meta = tables.scan_metadata(raw["runs"], raw["tasks"], raw["pipelines"], None, day)
    runs = meta["runs"]
    day_runs = features.day_targets(runs, day)
    frame = features.inference_frame(
        day, runs, meta["tasks"], meta["pipelines"], _signals(raw["logs"], day_runs, with_logs), plan
    )
    predictions = score.predict(
        bundle, frame, raw["logs"] if with_logs else None, runs, **thresholds
    )
    artefacts.write_dated(predictions, f"{out}/{PREDICTIONS}", day)
    stored = spark.read.parquet(f"{out}/{PREDICTIONS}").where(F.col("dt") == F.lit(day)).drop("dt")
    artefacts.write_artefact(stored, out, publish.dated_target(PREDICTED, day), [F.desc(report.PROB), "dag_id", "run_id"])
    return stored


def report_job(
    spark: SparkSession,
    locations: Mapping[str, str],
    out: str,
    day: date,
    top_n: int = 10,
    with_logs: bool = True,
) -> dict[str, DataFrame]:
    """Summary, table lines and root-cause sections of a day's predictions."""
    try:
        schema = spark.read.parquet(f"{out}/{PREDICTIONS}").drop("dt").schema
    except AnalysisException as exc:
        raise FileNotFoundError(f"no predictions under {out}") from exc
    now, before = artefacts.read_with_previous_day(spark, f"{out}/{PREDICTIONS}", day, StructType(schema.fields))
    parts = {
        "summary": report.report_summary(now, before, day),
        "lines": report.report_lines(report.top_rows(now, top_n)).select(
            "dag_id", "run_id", report.PROB, "line"
        ),
    }
    if with_logs:
        logs = tables.read_table(spark, "logs", locations)
        parts["root_causes"] = rca.rca_markdown(rca.root_cause_details(now, logs))
    for name, df in parts.items():
        artefacts.write_dated(df, f"{out}/report_{name}", day)
    artefacts.write_artefact(report_text(parts), out, publish.dated_target(REPORT, day), ["section", "place", "name"], "md")
    return parts


def report_text(parts: Mapping[str, DataFrame]) -> DataFrame:
    """(section, place, name, value): the lines of the daily report; ordered by the first three."""
    head = F.array("title", F.lit(""), "total_line", "high_line", "trend_line", F.lit(""))
    text = parts["summary"].select(F.lit(0).alias("section"), F.posexplode(head).alias("at", "value"))
    text = text.select("section", F.col("at").cast("double").alias("place"), F.lit("").alias("name"), "value")
    rows = parts["lines"].select(F.lit(1), F.coalesce(-F.col(report.PROB), F.lit(1.0)), F.concat_ws(" ", "dag_id", "run_id"), "line")
    text = text.unionAll(rows)
    if "root_causes" in parts:
        text = text.unionAll(parts["root_causes"].select(F.lit(2), F.lit(0.0), "dag_id", F.concat(F.lit("\n"), F.col("markdown"))))
    return text


def failed_runs_job(
    spark: SparkSession,
    locations: Mapping[str, str],
    out: str,
    day: date,
    back_days: int = 7,
) -> DataFrame:
    """Failed-run summary over the lookback; replaces that day's table."""
    logs = tables.read_table(spark, "logs", locations)
    summary = rca.failed_run_report(logs, day, back_days)
    lines = rca.failed_run_lines(summary)
    artefacts.write_dated(lines, f"{out}/failed_runs_rca", day)
    artefacts.write_artefact(summary, out, publish.dated_target(FAILED, day), rca.failed_run_order())
    artefacts.write_artefact(lines.withColumn("value", F.col("line")), out, publish.dated_target(FAILED_REPORT, day), rca.failed_run_order(), "md")
    return summary


def _csv_hash(spark: SparkSession, path: str, target: str, column: str | None, values: Sequence[str] | None) -> DataFrame:
    """(target, content_hash) of a CSV after its kind's filter; no rows left is a header, a missing file no row."""
    nothing = spark.createDataFrame([], "target string, content_hash string")
    try:
        rows = artefacts.read_csv(spark, path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return nothing
    columns = rows.columns
    if not columns:
        return artefacts.read_text(spark, path).select(F.lit(target).alias("target"), publish.text_hash("text").alias("content_hash")).limit(1)
    kept = publish.kept_rows(artefacts.numbered_csv(rows), column, values).withColumn("_target", F.lit(target))
    numbered = with_group_index(kept.withColumnRenamed("_row_no", "_place"), ["_target"], ["_file", "_place"], "_row_no")
    hashed = publish.table_hash(numbered, columns, "_target", "_row_no").select(F.col("_target").alias("target"), "content_hash")
    header = F.lit(publish.header_hash(columns))
    one = spark.range(1).select(F.lit(target).alias("target"))
    return one.join(hashed, ["target"], "left").select("target", F.coalesce("content_hash", header).alias("content_hash"))


def publish_job(
    spark: SparkSession,
    root: str,
    pages: DataFrame,
    state: DataFrame,
    run_day: date,
    cfg: PublishSettings = PublishSettings(),
    kinds: Sequence[tuple] = publish.KINDS,
) -> DataFrame:
    """Publish plan over the files under ``root``.

    The target date lies ``lookback_days`` before the run and discovery looks back as
    many days again. Files of artefacts whose page exists are not read. The content of a
    kind with a row filter is what the filter leaves.
    """
    target = run_day - timedelta(days=cfg.lookback_days)
    found = durable(
        publish.discover(
            artefacts.list_objects(spark, root), target, cfg.lookback_days, kinds
        )
    )
    open_ones = found.join(
        pages.select("title").distinct().withColumn("dated", F.lit(True)),
        ["title", "dated"],
        "left_anti",
    )
    hashes = spark.createDataFrame([], "target string, content_hash string")
    # At most one path per kind and day of the lookback.
    for r in open_ones.select("target", "render_kind", "kept_column", "kept_values").collect():
        if r["render_kind"] == "csv":
            one = _csv_hash(spark, f"{root.rstrip('/')}/{r['target']}", r["target"], r["kept_column"], r["kept_values"])
        else:
            one = artefacts.read_target(spark, root, r["target"]).select("target", publish.text_hash("text").alias("content_hash"))
        hashes = hashes.unionAll(one)
    return publish.publish_plan(found, pages, hashes, state)
