"""Train, predict, report, failed runs and publish, end to end on files."""

import hashlib
import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from pipewatch.plans import jobs, publish, report
from pipewatch.schemas import LOGS
from pipewatch.sources import artefacts

DAY = date(2024, 4, 10)
CANDIDATES = [{"n_estimators": 3, "max_depth": 2, "learning_rate": 0.3, "subsample": 1.0, "colsample": 1.0}]
RISK = {"high": 0.3, "medium": 0.1}


def write_tables(spark, root):
    rnd = random.Random(2)
    runs, tasks, logs = [], [], []
    for d in range(70):
        for p in range(6):
            t = datetime(2024, 2, 1) + timedelta(days=d, hours=p)
            failed = rnd.random() < (0.7 if p < 2 else 0.1)
            rid = f"r{d}_{p}"
            state = "failed" if failed else "success"
            for version, s in ((0, "running"), (1, state)):
                runs.append((f"p{p}", rid, t, s, t, t + timedelta(minutes=p + 1), "scheduled", False, t + timedelta(hours=version)))
            tasks.append((f"p{p}", rid, "t1", -1, state, 1 + failed, t, t - timedelta(minutes=1), t))
            if failed:
                logs.append((f"p{p}", rid, "t1", 1, t, "ERROR", None, "Quota exceeded", None))
    spark.createDataFrame(
        runs,
        "dag_id string, run_id string, execution_date timestamp, state string, start_date timestamp, end_date timestamp,"
        " run_type string, external_trigger boolean, insert_time timestamp",
    ).write.parquet(f"{root}/runs")
    spark.createDataFrame(
        tasks,
        "dag_id string, run_id string, task_id string, map_index int, state string, try_number int,"
        " start_date timestamp, queued_dttm timestamp, insert_time timestamp",
    ).write.parquet(f"{root}/tasks")
    spark.createDataFrame(
        [(f"p{p}", False, True, "@daily", datetime(2024, 1, 1)) for p in range(8)],
        "dag_id string, is_paused boolean, is_active boolean, schedule_interval string, insert_time timestamp",
    ).write.parquet(f"{root}/pipelines")
    spark.createDataFrame(logs, LOGS).write.parquet(f"{root}/logs")
    return {n: f"{root}/{n}" for n in ("runs", "tasks", "pipelines", "logs")}


def test_jobs(spark, tmp_path):
    where = write_tables(spark, str(tmp_path))
    out = str(tmp_path / "out")
    bundle = jobs.train_job(spark, where, out, DAY, candidates=CANDIDATES)
    stored = spark.read.parquet(f"{out}/artefacts/training_features")
    # One row per run and not per version; history reaches back before the targets.
    assert stored.count() == len({r.run_id for r in stored.select("run_id").collect()})
    assert stored.agg({"runs_count_90d": "max"}).first()[0] > 30
    assert bundle.threshold > 0

    predictions = jobs.predict_job(spark, where, out, date(2024, 4, 10), **RISK)
    ids = {r.dag_id for r in predictions.collect()}
    # No run that day: one expected target per pipeline known from the runs.
    assert ids == {f"p{p}" for p in range(6)}
    high = predictions.where("risk_bucket = 'High'").collect()
    assert high and all(r.rca_error_category == "QuotaRateLimit" for r in high if r.dag_id in ("p0", "p1"))
    assert all(len(r.top_drivers.split("|")) == 3 for r in predictions.collect())

    jobs.predict_job(spark, where, out, date(2024, 4, 9), **RISK)
    parts = jobs.report_job(spark, where, out, DAY)
    assert parts["summary"].first().trend_line.startswith("- High-risk count change vs yesterday")
    assert parts["lines"].count() >= len(high)
    assert "QuotaRateLimit" in parts["root_causes"].first().markdown
    failed = jobs.failed_runs_job(spark, where, out, date(2024, 4, 9))
    found = publish.discover(artefacts.list_objects(spark, out), DAY)
    assert {r.target for r in found.where("dated").collect()} == {
        "outputs/grid_cv_predictions_20240410.csv", "outputs/grid_cv_predictions_20240409.csv", "outputs/report_20240410.md",
        "outputs/failed_runs_rca_20240409.csv", "outputs/failed_runs_rca_report_20240409.md",
    }
    stored = artefacts.numbered_csv(artefacts.read_csv(spark, f"{out}/outputs/grid_cv_predictions_20240410.csv"))
    assert [r.run_id for r in stored.orderBy("_file", "_row_no").collect()] == [r.run_id for r in predictions.orderBy(F.desc(report.PROB), "dag_id", "run_id").collect()]
    assert failed.count() > 0 and spark.read.parquet(f"{out}/failed_runs_rca").count() == failed.count()


def test_publish_job(spark, tmp_path):
    root = tmp_path / "store"
    for name, text in {
        "outputs/report_20240408.md": "# a",
        "outputs/report_20240407.md": "# b",
        "outputs/report_20240401.md": "# old",
        "artefacts/grid_cv_train_metrics.json": "{}",
    }.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    pages = spark.createDataFrame([("Daily Report — 2024-04-07",)], "title string")
    state = spark.createDataFrame([], "state_key string, page_id string, content_hash string")
    plan = jobs.publish_job(spark, str(root), pages, state, DAY)
    got = {r.target: r.action for r in plan.collect()}
    assert got == {
        "outputs/report_20240408.md": "publish",
        "outputs/report_20240407.md": "skipped_existing",
        "artefacts/grid_cv_train_metrics.json": "publish",
        "artefacts/grid_cv_feature_importance.csv": "error",
    }
    listed = artefacts.list_objects(spark, str(root), "*.md")
    assert listed.count() == 3
    assert artefacts.try_read_text(spark, str(root / "none.md")).count() == 0
    (root / "x.csv").write_text('a,b\n1,"two\nlines"\n')
    rows = artefacts.read_source(spark, "file", str(root / "x.csv"), "csv").collect()
    assert [tuple(r) for r in rows] == [("1", "two\nlines")]


def test_publish_job_takes_notable_rows_only(spark, tmp_path):
    target = "outputs/grid_cv_predictions_20240408.csv"
    path = tmp_path / "store" / target
    path.parent.mkdir(parents=True)
    pages = spark.createDataFrame([], "title string")
    state = spark.createDataFrame([], "state_key string, page_id string, content_hash string")

    def content(text):
        path.write_text(text)
        plan = jobs.publish_job(spark, str(tmp_path / "store"), pages, state, DAY)
        row = plan.where(F.col("target") == target).first()
        return row.action, row.content_hash

    head = "run_id,risk_bucket,note\n"
    kept = 'r1,High,"a, b"\nr3,Med,\n'
    lines = "".join(hashlib.sha256(line.encode()).hexdigest() for line in kept.splitlines(True))
    want = ("publish", hashlib.sha256((head + hashlib.sha256(lines.encode()).hexdigest()).encode()).hexdigest())
    assert content(head + 'r1,High,"a, b"\nr2,Low,x\nr3,Med,\n') == want
    assert content(head + 'r0,Low,y\nr1,High,"a, b"\nr3,Med,\n') == want
    assert content(head + "r0,Low,y\n") == ("publish", hashlib.sha256(head.encode()).hexdigest())
