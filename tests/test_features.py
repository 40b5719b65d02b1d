"""Feature frame against a plain-Python evaluation, with edge rows."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pipewatch.plans import features as ft
from pipewatch.plans.logs import run_log_signals
from pipewatch.schemas import LOGS, PIPELINES

CFG = ft.FramePlan(critical_tasks=("t1",))
FAILED = {"failed", "upstream_failed", "timeout"}
BASE = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def tables(spark):
    rnd = random.Random(11)
    runs, tasks = [], []
    states = ["failed", "success", "Failed", "running", "timeout", None, "skipped"]
    for i in range(160):
        dag = rnd.choice(["hot", "hot", "a", "b"])
        t = BASE + timedelta(hours=rnd.randrange(0, 24 * 100) // 3 * 3)
        end = None if i % 9 == 0 else t + timedelta(seconds=rnd.randrange(5, 5000))
        runs.append((dag, f"r{i:03d}", t, rnd.choice(states), t, end))
        for j in range(rnd.randrange(0, 4)):
            s = None if rnd.random() < 0.2 else t + timedelta(days=rnd.randrange(-40, 30), minutes=j)
            q = None if rnd.random() < 0.2 else (s or t) - timedelta(minutes=rnd.randrange(0, 90))
            tasks.append(
                (dag, f"t{j}", f"r{i:03d}", rnd.choice(["failed", "success", "SKIPPED", None]),
                 rnd.choice([None, 1, 2, 3]), s, q)
            )
    runs += [
        ("a", "r_null", None, "failed", BASE, BASE),
        (None, "r_nodag", BASE + timedelta(days=9), "failed", BASE, BASE),
    ]
    r = spark.createDataFrame(
        runs, "dag_id string, run_id string, logical_date timestamp, state string, start_date timestamp, end_date timestamp"
    )
    t = spark.createDataFrame(
        tasks,
        "dag_id string, task_id string, run_id string, state string, try_number int, start_date timestamp, queued_dttm timestamp",
    )
    return runs, tasks, r, t


def mean(values):
    values = list(values)
    return sum(values) / len(values) if values else None


def p95(values):
    v = sorted(values)
    if not v:
        return None
    p = 0.95 * (len(v) - 1)
    lo = int(p)
    return v[lo] + (v[min(lo + 1, len(v) - 1)] - v[lo]) * (p - lo)


def expected(run, runs, tasks):
    dag, _rid, t = run[:3]
    out = {}
    hist = sorted(
        (r for r in runs if dag and t and r[0] == dag and r[2] and r[2] < t), key=lambda r: (r[2], r[1])
    )
    for w in (7, 30, 90):
        h = [r for r in hist if r[2] >= t - timedelta(days=w)]
        out[f"runs_count_{w}d"] = len(h)
        out[f"failure_rate_{w}d"] = mean((r[3] or "").lower() in FAILED for r in h)
    d = [(r[5] - r[4]).total_seconds() for r in hist if r[2] >= t - timedelta(days=30) and r[5]]
    out["mean_duration_30d"] = mean(d)
    out["p95_duration_30d"] = p95(d)
    m = mean(d)
    out["duration_std_30d"] = mean((x - m) ** 2 for x in d) ** 0.5 if d else None
    streak = 0
    for r in reversed(hist):
        if (r[3] or "").lower() not in FAILED:
            break
        streak += 1
    out["consecutive_failures"] = streak
    ids = {r[1] for r in hist}
    th = [x for x in tasks if x[0] == dag and x[2] in ids]
    t30 = [x for x in th if (x[5] or x[6]) and (x[5] or x[6]) >= t - timedelta(days=30)]
    out["avg_retries_30d"] = mean((x[4] or 0) - 1 for x in t30)
    out["retry_rate_30d"] = mean((x[4] or 0) > 1 for x in t30)
    out["failed_tasks_rate_30d"] = mean((x[3] or "").lower() in {"failed", "upstream_failed", "skipped"} for x in t30)
    out["critical_tasks_failed_rate_30d"] = mean((x[3] or "").lower() == "failed" for x in t30 if x[1] == "t1")
    q7 = [x for x in th if x[6] and x[6] >= t - timedelta(days=7)]
    out["avg_queue_time_7d"] = mean((x[5] - x[6]).total_seconds() for x in q7 if x[5])
    hour = timedelta(hours=1)
    out["concurrent_runs_proxy"] = sum(
        1 for r in runs if t and r[2] and (r[3] or "").lower() == "running" and t - hour <= r[2] <= t + hour
    )
    for n in (1, 24):
        out[f"pool_pressure_proxy_{n}h"] = sum(1 for x in tasks if t and x[6] and t - n * hour <= x[6] <= t)
    return out


def test_frame_equals_plain_python(spark, tables):
    runs, tasks, r, t = tables
    pipelines = spark.createDataFrame([], PIPELINES)
    got = {row.run_id: row for row in ft.feature_frame(r, r, t, pipelines, None, CFG).collect()}
    assert len(got) == len(runs)
    for run in runs:
        for name, value in expected(run, runs, tasks).items():
            assert got[run[1]][name] == pytest.approx(value, abs=1e-6), (run, name)
    assert got["r_null"].runs_count_90d == 0 and got["r_null"].failure_rate_7d is None
    assert got["r_nodag"].consecutive_failures == 0


def test_single_families_agree_with_frame(spark, tables):
    _runs, _tasks, r, t = tables
    frame = ft.feature_frame(r, r, t, spark.createDataFrame([], PIPELINES), None, CFG)
    for part in (
        ft.with_history(r, r, CFG), ft.with_streaks(r, r, CFG), ft.with_task_history(r, t, r, CFG),
        ft.with_pressure(r, t, r, CFG), ft.with_durations(r, r, CFG),
    ):
        names = ["run_id"] + [c for c in part.columns if c in frame.columns and c not in r.columns]
        assert len(names) > 1
        a = sorted(map(tuple, part.select(*names).collect()), key=str)
        b = sorted(map(tuple, frame.select(*names).collect()), key=str)
        assert a == b


def test_targets(spark):
    runs = spark.createDataFrame(
        [("a", "1", "Failed "), ("a", "2", "success"), ("a", "3", "Running"), ("a", "4", None), ("a", "5", "odd")],
        "dag_id string, run_id string, state string",
    )
    kept, dropped = ft.training_targets(runs)
    assert {(x.run_id, x.label_failed) for x in kept.collect()} == {("1", 1.0), ("2", 0.0)}
    assert {x.run_id for x in dropped.collect()} == {"3", "4", "5"}


def test_inference_coverage(spark):
    day = date(2024, 5, 6)  # a Monday
    runs = spark.createDataFrame(
        [("a", "1", datetime(2024, 5, 6), "success"), ("b", "2", datetime(2024, 5, 7), "success")],
        "dag_id string, run_id string, logical_date timestamp, state string",
    )
    rows = [
        ("a", False, True, "@daily"), ("b", False, True, "@daily"), ("c", None, None, None),
        ("d", True, True, "@daily"), ("e", False, False, "@daily"), ("f", False, True, "0 0 * * 2"),
        ("g", False, True, "@once"), ("h", False, True, "0 5 * * MON"), ("h", False, True, "0 5 * * MON"),
    ]
    pipes = spark.createDataFrame(rows, "dag_id string, is_paused boolean, is_active boolean, schedule_interval string")
    got = {(x.dag_id, x.run_id) for x in ft.inference_targets(runs, pipes, day).collect()}
    synthetic = {(d, f"predicted_2024-05-06_{d}") for d in "bch"}
    assert got == {("a", "1")} | synthetic
    none = ft.inference_targets(runs.limit(0), pipes, day).collect()
    assert {x.dag_id for x in none} == set("abch")


def test_pipeline_facts_defaults(spark):
    t = spark.createDataFrame([("a", datetime(2024, 1, 2)), ("z", datetime(2024, 1, 2))], "dag_id string, logical_date timestamp")
    pipes = spark.createDataFrame(
        [("a", None, None, datetime(2024, 1, 1, 12), "@daily", "f", "o", None, 1, None, 3)], PIPELINES
    )
    got = {r.dag_id: r for r in ft.with_pipeline_facts(t, pipes).collect()}
    a, z = got["a"], got["z"]
    assert (a.dag_last_parsed_age_hours, a.dag_paused_flag, a.dag_is_active_flag, a.has_import_errors) == (12.0, 0, 1, 0)
    assert (z.dag_last_parsed_age_hours, z.dag_paused_flag, z.owners) == (None, None, None)


def test_log_signals(spark):
    ts = [BASE + timedelta(minutes=i) for i in range(6)]
    rows = [
        ("a", "1", "t", 1, ts[0], "ERROR", None, "Quota exceeded\nretrying", None),
        ("a", "1", "t", 1, ts[1], "ERROR", None, None, "  "),
        ("a", "1", "t", 1, ts[2], "ERROR", None, "m", "Traceback (most recent call last):\nauthor error 404"),
        ("a", "1", "t", 1, ts[3], "ERROR", None, "newest: timeout", None),
        ("a", "2", "t", 1, ts[4], "ERROR", None, " ", None),
        ("a", "1", "t", 1, None, "ERROR", None, "no time: killed", None),
    ]
    logs = spark.createDataFrame(rows, LOGS).withColumn("logical_date", F.lit(BASE))
    got = run_log_signals(logs, tail_lines=1).collect()
    assert len(got) == 1
    r = got[0]
    # All logs count but the blank one; the log without a time is the oldest.
    assert (r.log_objects_parsed, r.stacktrace_seen_count) == (4, 1)
    assert (r.error_cat_quota_rate_limit, r.error_cat_permission_auth, r.error_cat_other) == (1, 1, 2)
    assert (r.kw_retrying, r.kw_killed, r.error_cat_timeout, r.error_cat_not_found) == (1, 1, 1, 1)
    assert r.error_cat_other_rate == pytest.approx(2 / 4)
    assert r.last_n_lines_summary == "retrying\n\n---\n\nauthor error 404\n\n---\n\nnewest: timeout"
