"""Root causes, reports, publishing on edge rows."""

import hashlib
import html
import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pipewatch.operators.ranking import with_group_index
from pipewatch.plans import publish, quality, rca, report
from pipewatch.schemas import LOGS, RUNS, conform
from pipewatch.settings import PublishSettings
from pipewatch.sources import artefacts, tables

T = datetime(2024, 3, 1, 12)


def logs_df(spark, rows):
    return spark.createDataFrame(rows, LOGS)


@pytest.fixture(scope="module")
def logs(spark):
    h = timedelta(hours=1)
    return logs_df(
        spark,
        [
            ("a", "r1", "t2", 1, T, "error", "s", "bang", "x\nKeyError: k"),
            ("a", "r1", "t1", 3, T - h, "CRITICAL", "s", "old", None),
            ("a", "r2", "t1", None, T - 2 * h, None, None, None, None),
            ("a", "r2", "t2", 2, None, "ERROR", None, "undated 429", None),
            ("b", None, None, None, T, "INFO", None, None, ""),
            (None, "r9", "t", 1, T, "ERROR", None, "lost", None),
        ],
    )


def test_summary(spark, logs):
    got = {r.dag_id: r for r in rca.rca_summary(logs).collect()}
    a, b = got["a"], got["b"]
    assert set(got) == {"a", "b"}
    assert (a.rca_error_category, a.rca_top_error, a.rca_stack_hint) == ("CodeError", "bang", "KeyError: k")
    assert (a.rca_top_task, a.rca_severity, a.rca_recurrence) == ("t1", "CRITICAL", 2)
    assert (a.rca_error_count, a.rca_try_number_max) == (4, 3)
    assert (a.rca_first_seen, a.rca_last_seen) == ("2024-03-01 10:00:00", "2024-03-01 12:00:00")
    assert (b.rca_error_category, b.rca_top_task, b.rca_severity, b.rca_recurrence) == ("Other", "", "INFO", 0)


def test_detail_and_markdown(spark, logs):
    d = {r.dag_id: r for r in rca.rca_detail(logs).collect()}
    assert [e.message for e in d["a"].top_entries] == ["bang", "old", "", "undated 429"]
    md = {r.dag_id: r.markdown for r in rca.rca_markdown(rca.rca_detail(logs)).collect()}
    assert "| **Latest Error** | bang |" in md["a"] and "   > _KeyError: k_" in md["a"]
    assert "| **Top Failing Task** | - |" in md["b"] and "Stack Hint" not in md["b"]


def test_failed_runs_keep_null_keys(spark, logs):
    got = {(r.dag_id, r.run_id): r for r in rca.failed_run_summary(logs).collect()}
    assert set(got) == {("a", "r1"), ("a", "r2"), ("b", None), (None, "r9")}
    assert got[("a", "r2")].error_category == "Other" and got[("a", "r2")].max_try_number == 2
    assert got[(None, "r9")].top_failing_task == "t"


def test_failed_run_order_and_bounds(spark):
    day = date(2024, 3, 1)
    rows = [
        ("a", "1", "t", 1, datetime(2024, 2, 24), "ERROR", None, "at the start", None),
        ("a", "2", "t", 1, datetime(2024, 2, 24, 1), "ERROR", None, "m", None),
        ("a", "2", "t", 1, datetime(2024, 2, 24, 2), "error", None, "m", None),
        ("a", "3", "t", 1, datetime(2024, 2, 25), "critical", None, "m|x", None),
        ("a", "4", "t", 1, datetime(2024, 3, 2), "ERROR", None, "at the end", None),
        ("a", "5", "t", 1, datetime(2024, 3, 1), "WARNING", None, "mild", None),
    ]
    out = rca.failed_run_report(logs_df(spark, rows), day, 7)
    assert [r.run_id for r in out.collect()] == ["3", "2"]
    assert [r.run_id for r in out.orderBy(*rca.failed_run_order(alphabetical=True)).collect()] == ["2", "3"]
    lines = {r.run_id: r.line for r in rca.failed_run_lines(out).collect()}
    assert lines["3"] == "| a | 3 | CRITICAL | 1 | t | 1 | Other | mx |"


def test_enrichment_defaults(spark, logs):
    preds = spark.createDataFrame(
        [("a", "x", "High"), ("b", "y", "Low"), ("z", "q", "High"), (None, "n", "High")],
        "dag_id string, run_id string, risk_bucket string",
    )
    got = {r.run_id: r for r in rca.with_root_causes(preds, logs).collect()}
    assert got["x"].rca_error_count == 4
    assert all(got[k].rca_error_count == 0 and got[k].rca_severity == "" for k in "yqn")
    runs = spark.createDataFrame([("a", "Failed")], "dag_id string, state string")
    assert {r.rca_error_count for r in rca.with_root_causes(preds, logs, runs).collect()} == {0}
    assert {r.rca_error_count for r in rca.with_root_causes(preds, None).collect()} == {0}


# --- reports --------------------------------------------------------------


def scored(spark, probs):
    rows = [(f"d{i}", f"r{i}", p) for i, p in enumerate(probs)]
    return spark.createDataFrame(rows, f"dag_id string, run_id string, {report.PROB} double")


def test_thresholds(spark):
    def pair(probs, high=0.7, med=0.4):
        r = report.adaptive_thresholds(scored(spark, probs), high=high, med=med).first()
        return r.high, r.med

    assert pair([0.1, 0.9]) == (0.7, 0.4)
    assert pair([0.4, 0.1], 0.4, 0.7) == (0.7, 0.4)
    assert pair([0.1] * 4) == (pytest.approx(0.1 + 1e-6), 0.1)
    low = [i / 100 for i in range(11)]
    assert pair(low) == (pytest.approx(0.09), pytest.approx(0.07))
    assert pair([float("nan")], 0.3, 0.6) == (0.3, 0.6)


def test_top_rows(spark):
    df = report.with_risk(scored(spark, [0.9, 0.8, 0.5, 0.45, 0.1, float("nan")]))
    assert {r.run_id for r in report.top_rows(df, 3).collect()} == {"r0", "r1", "r2"}
    assert {r.run_id for r in report.top_rows(df, 1).collect()} == {"r0", "r1"}
    assert report.top_rows(df, 9).count() == 6


def test_trend_needs_the_day_before(spark):
    df = spark.createDataFrame(
        [(date(2024, 1, 1), "High"), (date(2024, 1, 2), "Low"), (date(2024, 1, 4), "High")], "day date, risk_bucket string"
    )
    got = {r.day.day: r.high_risk_change for r in report.risk_trend(df, "day").collect()}
    assert got == {1: None, 2: -1, 4: None}
    none = report.report_summary(df, df.limit(0), date(2024, 1, 4)).first()
    assert none.trend_line.endswith("(no previous predictions file).")


def test_quality(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("b", None)], "k string, v double")
    assert tuple(quality.duplicate_summary(df, ["k"]).first()) == (3, 2)
    assert [tuple(r) for r in quality.null_rates(df).collect()] == [("v", 2 / 3), ("k", 0.0)]
    assert tuple(quality.column_profile(df).first()) == ("v", 3, 2, 1.0, 1.0, 1.0)
    assert tuple(quality.duplicate_summary(df.limit(0), ["k"]).first()) == (0, 0)


# --- sources --------------------------------------------------------------


def test_conform(spark):
    df = spark.createDataFrame([("a", "x", 1)], "DAG_ID string, clear_number string, other int")
    out = conform(df, RUNS)
    assert out.schema == RUNS
    assert (out.first().dag_id, out.first().clear_number, out.first().run_id) == ("a", None, None)


def test_filter_before_version(spark):
    df = spark.createDataFrame(
        [("a", "1", "failed", T, T), ("a", "1", "success", T + timedelta(days=40), T + timedelta(hours=1))],
        "dag_id string, run_id string, state string, execution_date timestamp, insert_time timestamp",
    )
    whole = tables.latest_scan(df, "runs").collect()
    assert [r.state for r in whole] == ["success"]
    cut = tables.latest_scan(df, "runs", tables.date_range("execution_date", None, date(2024, 3, 5)))
    assert [r.state for r in cut.collect()] == ["failed"]


def test_absent_tables(spark, tmp_path):
    assert tables.read_table(spark, "runs", {}).schema == RUNS
    assert tables.read_table(spark, "runs", {"runs": str(tmp_path / "none")}).count() == 0
    assert tables.read_table(spark, "logs", {"logs": "no_such_table"}).schema == LOGS


def test_logs_without_dates(spark, logs):
    runs = spark.createDataFrame([("a", "r1", None)], "dag_id string, run_id string, logical_date timestamp")
    assert tables.logs_of_runs(logs, runs).count() == 2
    near = spark.createDataFrame([("a", "r1", T + timedelta(days=2))], "dag_id string, run_id string, logical_date timestamp")
    assert tables.logs_of_runs(logs, near).count() == 1


def test_dated_tables(spark, tmp_path):
    path = str(tmp_path / "p")
    for n, d in ((1, date(2024, 1, 1)), (2, date(2024, 1, 2)), (3, date(2024, 1, 2))):
        artefacts.write_dated(spark.range(n), path, d)
    now, before = artefacts.read_with_previous_day(spark, path, date(2024, 1, 2), spark.range(1).schema)
    assert (now.count(), before.count()) == (3, 1)
    none, _ = artefacts.read_with_previous_day(spark, str(tmp_path / "q"), date(2024, 1, 2), spark.range(1).schema)
    assert none.count() == 0


# --- publishing -----------------------------------------------------------

DAY = date(2026, 6, 12)


def test_discovery(spark):
    paths = [
        "base/outputs/failed_runs_rca_20260612.csv", "base/outputs/failed_runs_rca_report_20260611.md",
        "base/outputs/failed_runs_rca_report_20260611.html", "base/outputs/report_20260610.md",
        "base/outputs/report_20260609.md", "base/outputs/report_20260613.md", "base/outputs/report_20260699.md",
        "base/outputs/report_20260610.md",
    ]
    objects = spark.createDataFrame([(p,) for p in paths], "path string")
    got = sorted(r.title for r in publish.discover(objects, DAY, 2).collect())
    assert got == [
        "Daily Report — 2026-06-10", "Failed Runs RCA Report — 2026-06-11", "Failed Runs RCA — 2026-06-12",
        "Latest Feature Importance", "Latest Train Metrics",
    ]
    iso = [("x/y_{iso_date}.csv", "Y — {iso_date}", "Y", "csv", "file", None, None)]
    found = publish.discover(spark.createDataFrame([("a/x/y_2026-06-12.csv",)], "path string"), DAY, 2, iso)
    assert found.first().target == "x/y_2026-06-12.csv"


def test_plan_actions(spark):
    objects = spark.createDataFrame(
        [(f"o/outputs/report_202606{d}.md",) for d in (10, 11, 12)], "path string"
    )
    found = publish.discover(objects, DAY, 2)
    pages = spark.createDataFrame([("Daily Report — 2026-06-10",), ("Latest Train Metrics",)], "title string")
    hashes = spark.createDataFrame(
        [("outputs/report_20260611.md", "h"), ("artefacts/grid_cv_train_metrics.json", "same"),
         ("artefacts/grid_cv_feature_importance.csv", "new")],
        "target string, content_hash string",
    )
    markers = spark.createDataFrame(
        [("artefacts_grid_cv_train_metrics_json", '{"page_id": "1", "content_hash": "same"}'),
         ("artefacts_grid_cv_feature_importance_csv", '{"page_id": 2, "content_hash": "old"}'),
         ("k3", "not json"), ("k4", '{"page_id": "5"}')],
        "state_key string, text string",
    )
    state = publish.parse_markers(markers)
    assert state.count() == 2
    got = {r.title: r.action for r in publish.publish_plan(found, pages, hashes, state).collect()}
    assert got == {
        "Daily Report — 2026-06-10": "skipped_existing", "Daily Report — 2026-06-11": "publish",
        "Daily Report — 2026-06-12": "error", "Latest Train Metrics": "skipped_unchanged",
        "Latest Feature Importance": "publish",
    }


def test_table_hash_is_sha_of_csv(spark):
    rows = [("t", i, f'a"{i}', "x,y" if i % 2 else None) for i in range(25)]
    df = spark.createDataFrame(rows, "target string, row_no long, p string, q string").repartition(5)
    lines = [f'"a""{i}",' + ('"x,y"' if i % 2 else "") + "\n" for i in range(25)]

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    def content(chunk_rows):
        chunks = [lines[i : i + chunk_rows] for i in range(0, 25, chunk_rows)]
        return sha("p,q\n" + "".join(sha("".join(map(sha, c))) for c in chunks))

    one = publish.table_hash(df, ["p", "q"]).first()
    assert one.content_hash == content(25)
    assert (one.raw_bytes, one.row_count) == (4 + len("".join(lines)), 25)
    # The same definition with one chunk and with several.
    assert publish.table_hash(df, ["p", "q"], chunk_rows=10).first().content_hash == content(10)
    assert publish.header_hash(["p", "q"]) == sha("p,q\n")
    chunks = publish.payload_chunks(df, ["p", "q"], chunk_rows=10).orderBy("chunk_no").collect()
    assert [(c.chunk_no, c.row_count) for c in chunks] == [(0, 10), (1, 10), (2, 5)]
    parts = publish.table_hash(df, ["p", "q"], chunk_rows=10).first()
    changed = publish.table_hash(df.withColumn("q", F.when(F.col("row_no") != 24, F.col("q")).otherwise("z")), ["p", "q"], chunk_rows=10)
    assert parts.content_hash != one.content_hash != changed.first().content_hash
    assert parts.raw_bytes == one.raw_bytes
    indexed = with_group_index(df.select("target", F.col("row_no").alias("o")), ["target"], ["o"])
    assert indexed.where("o <> row_no").count() == 0


def test_pages_and_gate(spark):
    rows = [("t", "T & t", i, "<b>", "l1\nl2") for i in range(4)] + [("u", "U", 0, None, "w" * 900)]
    df = spark.createDataFrame(rows, "target string, title string, row_no long, c string, latest_message string")
    cfg = PublishSettings(row_cap=3, warn_bytes=700, hard_limit_bytes=1000)
    got = {r.target: r for r in publish.table_pages(df, ["c", "latest_message"], "s", "now", cfg).collect()}
    t, u = got["t"], got["u"]
    assert t.size_verdict == "warn" and t.attempted_bytes == t.body_bytes == len(t.body.encode())
    assert t.body.startswith("<!-- AUTO-GENERATED -->\n<h1>T &amp; t</h1><p><strong>Truncated at first 3 rows of 4 total.")
    assert t.body.count("<tr><td>&lt;b&gt;</td>") == 3 and "l1<br/>l2" in t.body and t.body.endswith("Rows: 4</em></p>")
    assert u.size_verdict == "placeholder" and u.body_bytes < u.attempted_bytes
    assert "is 921 bytes" in u.body or "bytes — rendering" in u.body


def test_json_rows(spark):
    df = spark.createDataFrame(
        [(1, '{"a": 1, "b": {"c": [1, 2], "d": "x"}, "e": [true, null]}'), (2, "broken"), (3, "[7]")], "id int, t string"
    )
    got = {(r.id, r.path): (r.depth, r.value, r.is_container) for r in publish.json_rows(df, "id", "t").collect()}
    assert got == {
        (1, "$.a"): (1, "1", False), (1, "$.b.c"): (2, "[1,2]", True), (1, "$.b.d"): (2, '"x"', False),
        (1, "$.e[0]"): (2, "true", False), (1, "$.e[1]"): (2, "null", False), (3, "$[0]"): (1, "7", False),
    }


def test_retention(spark):
    auto = "<!-- AUTO-GENERATED -->"
    rows = [
        ("1", "Daily Reports", "Daily Report — 2026-05-29", auto), ("2", "Daily Reports", "Daily Report — 2026-05-28", auto),
        ("3", "Daily Reports", "Daily Report — 2026-05-28", "mine"), ("4", "Train Metrics", "Latest Train Metrics", auto),
        ("5", "Daily Reports", "Daily Report — 2026-02-30", auto), ("6", "Other", "X — 2020-01-01", auto),
    ]
    df = spark.createDataFrame(rows, "page_id string, parent_title string, title string, body string")
    got = {r.page_id: r.action for r in publish.retention_sweep(df, DAY).collect()}
    assert got == {"1": "kept_recent", "2": "deleted", "3": "kept_human_owned", "4": "kept_rolling", "5": "kept_rolling"}
    free = publish.retention_sweep(df, DAY, PublishSettings(auto_marker=""))
    assert {r.page_id for r in free.where("action = 'deleted'").collect()} == {"2", "3"}


def test_row_filter_passes_unknown_schema(spark):
    df = spark.createDataFrame([("Low",), ("Med",), ("High",), (None,)], "risk_bucket string")
    assert publish.kept_rows(df, "risk_bucket", ["Med", "High"]).count() == 2
    assert publish.kept_rows(spark.range(3), "risk_bucket", ["Med"]).count() == publish.kept_rows(spark.range(3), None, None).count() == 3


def test_parts_hold_every_row_and_text(spark):
    cfg = PublishSettings(row_cap=7, warn_bytes=3000, hard_limit_bytes=4000)
    rows = spark.createDataFrame([("t", "T", i, f"cell {i:03d} " + "x" * (300 if i % 5 == 0 else 3)) for i in range(40)], "target string, title string, row_no long, c string")
    parts = publish.table_parts(rows, ["c"], "s", "now", cfg).orderBy("page_no").collect()
    assert [p.page_no for p in parts] == list(range(1, len(parts) + 1)) and len(parts) >= 6
    assert all(p.row_count <= 7 and p.body_bytes < 4000 for p in parts)
    assert re.findall(r"cell (\d+)", "".join(p.body for p in parts)) == [f"{i:03d}" for i in range(40)]
    text = "".join(f"<{i}>é" for i in range(900))
    texts = spark.createDataFrame([("a", "A", text), ("b", "B", None)], "target string, title string, text string")
    got = publish.text_parts(texts, "s", "now", cfg).orderBy("target", "page_no").collect()
    assert html.unescape("".join(re.search("<pre>(.*)</pre>", r.body)[1] for r in got if r.target == "a")) == text
    assert [r.page_no for r in got if r.target == "b"] == [1] and all(len(r.body.encode()) < 4000 for r in got)
