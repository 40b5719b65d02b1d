"""Publish runs: pages, payload and state; repeated and half-failed runs."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from pipewatch.plans import jobs, publish, publishing
from pipewatch.settings import PublishSettings
from pipewatch.sources import artefacts, typed

DAY = date(2024, 4, 10)
METRICS = "artefacts/grid_cv_train_metrics.json"
IMPORTANCE = "artefacts/grid_cv_feature_importance.csv"
SCORES = "outputs/grid_cv_predictions_20240408.csv"
REPORT = "outputs/report_20240408.md"


def put(root, files):
    for name, text in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)


def actions(plan):
    return {r.target: r.action for r in plan.collect()}


def payload(spark, store, run, target):
    rows = publishing.read_runs(spark, store, "payload").where((F.col("run") == run) & (F.col("target") == target))
    return [r.line for r in rows.orderBy("row_no").collect()]


def test_runs(spark, tmp_path, monkeypatch):
    root, store = tmp_path / "root", str(tmp_path / "store")
    long = "# a & b\n" + "x" * 100_000
    put(root, {
        METRICS: '{"threshold": 0.5, "params": {"depth": 3}}', IMPORTANCE: "feature,importance_mean\nf1,0.5\nf2,\n",
        SCORES: 'run_id,risk_bucket,note\nr1,High,"two\nlines, one"\nr2,Low,x\nr3,Med,\n', REPORT: long,
    })
    run = lambda run_id, hour: publishing.publish_run(spark, str(root), store, run_id, DAY, datetime(2024, 4, 10, hour))
    assert set(actions(run("1", 1)).values()) == {"publish"}
    pages = {r.target: r for r in publishing.current_pages(spark, store).collect()}
    assert set(pages) == {METRICS, IMPORTANCE, SCORES, REPORT}
    # The rows that the kind keeps, on the page and in the payload.
    assert "r1" in pages[SCORES].body and "r3" in pages[SCORES].body and "r2" not in pages[SCORES].body
    assert payload(spark, store, "1", SCORES) == ["run_id,risk_bucket,note", 'r1,High,"two\nlines, one"', "r3,Med,"]
    assert "$.params.depth" in pages[METRICS].body and "&amp; b" in pages[REPORT].body
    assert "".join(payload(spark, store, "1", REPORT)) == long
    described = publishing.read_runs(spark, store, "attachments").where(F.col("target") == SCORES).first()
    assert (described.attachment_filename, described.attachment_content_type) == ("grid_cv_predictions_20240408.csv", "text/csv")
    with pytest.raises(ValueError):
        run("1", 2)

    # Again: nothing to do, no page written anew.
    assert actions(run("2", 2)) == {
        METRICS: "skipped_unchanged", IMPORTANCE: "skipped_unchanged", SCORES: "skipped_existing", REPORT: "skipped_existing",
    }
    before = {r.state_key: r for r in publishing.newest_state(spark, store).collect()}

    # A run that fails after its state is written does not count.
    put(root, {METRICS: '{"threshold": 0.7}'})
    real = publishing.TABLES
    monkeypatch.setattr(publishing, "TABLES", real | {"outcomes": "no_such_column string"})
    with pytest.raises(Exception, match="no_such_column"):
        run("3", 3)
    monkeypatch.setattr(publishing, "TABLES", real)
    assert spark.read.parquet(f"{store}/state/run=3").count() == 1
    assert {r.state_key: r for r in publishing.newest_state(spark, store).collect()} == before
    assert "0.7" not in [r for r in publishing.current_pages(spark, store).collect() if r.target == METRICS][0].body

    # Repeated under its id: the new page under the old page's id.
    plan = run("3", 4)
    assert actions(plan)[METRICS] == "publish"
    assert {r.action: r.n for r in publish.outcome_summary(plan).collect()} == {"publish": 1, "skipped_unchanged": 1, "skipped_existing": 2}
    page = [r for r in publishing.current_pages(spark, store).collect() if r.target == METRICS]
    assert len(page) == 1 and "0.7" in page[0].body and page[0].page_id == pages[METRICS].page_id


def test_outputs_of_jobs_are_found_in_order(spark, tmp_path):
    root, store = str(tmp_path / "root"), str(tmp_path / "store")
    rows = spark.range(5000).select(F.format_string("r%04d", "id").alias("run_id"), F.lit("High").alias("risk_bucket"), F.array("id").alias("many"))
    artefacts.write_artefact(rows.repartition(7), root, publish.dated_target(jobs.PREDICTED, date(2024, 4, 8)), [F.desc("run_id")])
    lines = spark.range(300).select("id", F.concat(F.lit("- "), F.col("id").cast("string")).alias("value"))
    artefacts.write_artefact(lines.repartition(5), root, publish.dated_target(jobs.REPORT, date(2024, 4, 8)), ["id"], "md")
    cfg = PublishSettings(row_cap=1500)
    plan = publishing.publish_run(spark, root, store, "a", DAY, datetime(2024, 4, 10), cfg)
    found = actions(plan)
    assert found[SCORES] == found[REPORT] == "publish" and found[METRICS] == "error"
    want = [f"r{i:04d},High" for i in reversed(range(5000))]
    assert payload(spark, store, "a", SCORES) == ["run_id,risk_bucket", *want]
    assert "".join(payload(spark, store, "a", REPORT)) == "".join(f"- {i}\n" for i in range(300))
    parts = publishing.current_pages(spark, store).where(F.col("target") == SCORES).orderBy("page_no").collect()
    assert [p.page_no for p in parts] == [1, 2, 3, 4]
    assert parts[0].body.index("r4999") < parts[0].body.index("r4998") and "r0000" in parts[3].body


def test_empty_artefacts(spark, tmp_path):
    root, store = tmp_path / "root", str(tmp_path / "store")
    put(root, {SCORES: "run_id,risk_bucket\nr1,Low\n", REPORT: "", METRICS: "no json"})
    plan = publishing.publish_run(spark, str(root), store, "a", DAY, datetime(2024, 4, 10))
    got = actions(plan)
    assert got[SCORES] == got[METRICS] == "publish"
    bodies = {r.target: r.body for r in publishing.current_pages(spark, store).collect()}
    assert "Rows: 0" in bodies[SCORES] and "no json" in bodies[METRICS]
    assert payload(spark, store, "a", SCORES) == ["run_id,risk_bucket"]


def test_typed_rows_and_rejected_ones(spark):
    schema = "k int, at string, n string"
    rows = [(1, "2024-01-02 03:04:05", " 7 "), (2, None, ""), (3, "soon", "1e3"), (4, "2024-13-01", "x"), (4, " ", None), (None, "2024-02-30", "1_0")]
    df, kinds = spark.createDataFrame(rows, schema), {"at": "timestamp", "n": "number"}
    good = typed.typed_rows(df, kinds).collect()
    assert [r.n for r in good] == [7.0, None, 1000.0, None, None, None] and good[0]["at"] == datetime(2024, 1, 2, 3, 4, 5)
    assert all(r["at"] is None for r in good[1:])
    bad = typed.rejected_rows(df, ["k"], kinds).collect()
    assert sorted(map(tuple, bad), key=repr) == sorted([
        (3, "at", "soon", "no timestamp"), (4, "at", "2024-13-01", "no timestamp"), (4, "n", "x", "no number"),
        (None, "at", "2024-02-30", "no timestamp"), (None, "n", "1_0", "no number"),
    ], key=repr)
    assert typed.rejected_rows(df.limit(0), ["k"], kinds).count() == 0
