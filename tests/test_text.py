"""Log text, schedules, scalars on edge rows."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from pipewatch.functions import scalars, text
from pipewatch.functions.schedule import schedule_due


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", expr.alias("y")).orderBy("i").collect()]


LINES = ["a\nb", "a\r\nb\r\n", "a b\u0085c", "", "\n", "a\n\nb\n", "x\x0by\x1cz", None, "one"]


def test_split_lines_is_pythons(spark):
    got = column(spark, LINES, text.split_lines("x"))
    assert got == [None if s is None else s.splitlines() for s in LINES]


def test_tail(spark):
    got = column(spark, LINES[:-2] + ["1\n2\n3\n4"], text.tail_text(text.split_lines("x"), 2))
    assert got == ["\n".join(s.splitlines()[-2:]) for s in LINES[:-2] + ["1\n2\n3\n4"]]


def test_blank_and_text_choice(spark):
    df = spark.createDataFrame(
        [("  ", "m"), (None, "m"), ("f", "m"), (" ", None), (None, None)], "f string, m string"
    )
    got = [r.y for r in df.select(text.log_text("f", "m").alias("y")).collect()]
    assert got == ["m", "m", "f", "", ""]


def test_categories_in_order(spark):
    cases = {
        "No module named x; permission denied": "ImportError",
        "HTTP 401": "PermissionDenied",
        "diagram": "Other",
        "William": "PermissionDenied",
        "rate-limit": "QuotaRateLimit",
        "table a.b does not exist": "NotFound",
        "TypeError": "CodeError",
        "Task x has failed": "TaskFailed",
        "": "Other",
    }
    assert column(spark, list(cases), text.classify_error("x")) == list(cases.values())
    assert column(spark, [None], text.classify_error("x")) == ["Other"]


def test_case_blind_counts(spark):
    import re

    lines = [
        "TİMEOUT", "tıme out", "tıMeout", "ſocket", "IAM", "rate  limit", "RATE LIMIT", "job 1 FAILED", "failed job",
        "to\u212aen", "", "a.b?", "end.", "End!", "table x does not exist", None,
    ]
    groups = [
        ("timeout", "iam"), ("rate.?limit|429",), ("job.*failed",), ("token",), (r"[!?.]$",), ("socket|table.*not exist",),
        (r"(end|job)\W",),
    ]
    for pats in groups:
        got = column(spark, ["\n".join(x or "" for x in lines)], text.count_matching_lines(text.split_lines("x"), pats, "x"))
        want = sum(any(re.search(p, x or "", re.I) for p in pats) for x in lines)
        assert got == [want], pats
        each = column(spark, lines, text.matches_any(pats, F.col("x"), text.folded("x")))
        assert each == [None if x is None else any(re.search(p, x, re.I) is not None for p in pats) for x in lines], pats


def test_stack_hint(spark):
    values = [
        "Traceback\n  File x\nmy.mod.BadError: no\nlater line",
        "first\n  last  \n\n",
        "",
        None,
        "UserWarning: " + "w" * 300,
        "ErrorX is no exception line\nthe end",
    ]
    got = column(spark, values, text.stack_hint("x"))
    assert got[:4] == ["my.mod.BadError: no", "last", "", ""]
    assert got[4] == values[4][:200]
    assert got[5] == "the end"


def test_worst_severity(spark):
    df = spark.createDataFrame(
        [("a", "warning"), ("a", "Error"), ("b", "odd"), ("b", None), ("c", "critical"), ("c", "ERROR")],
        "k string, s string",
    )
    got = {r.k: r.w for r in df.groupBy("k").agg(text.worst_severity("s").alias("w")).collect()}
    assert got == {"a": "ERROR", "b": "INFO", "c": "CRITICAL"}


# --- schedules: an independent evaluator, value sets per field -------------


def expand(field, low, high):
    out = set()
    for token in field.split(","):
        base, _, step = token.partition("/")
        step_n = int(step or 1)
        if base == "*":
            lo, hi = low, high
        elif "-" in base:
            lo, hi = map(int, base.split("-"))
        else:
            lo = int(base)
            hi = high if step else lo
        out |= set(range(lo, hi + 1, step_n))
    return out


def fires(cron, d):
    _, _, dom, month, dow = cron.split()
    if d.month not in expand(month, 1, 12):
        return False
    in_dom = d.day in expand(dom, 1, 31)
    in_dow = d.isoweekday() % 7 in {v % 7 for v in expand(dow, 0, 7)}
    if dom == "*" or dow == "*":
        return in_dom and in_dow
    return in_dom or in_dow


CRONS = [
    "0 0 * * *", "0 6 * * 1-5", "*/15 8-18 1-10/3 * *", "0 0 13 * 5", "0 0 * 2,6 7",
    "30 1 31 */2 *", "0 0 */10 * 0", "5 4 * * 5-7", "0 0 1 1 *",
]


def test_schedule_days(spark):
    start = date(2023, 12, 20)
    days = [start + timedelta(days=i) for i in range(400)]
    rows = [(c, d) for c in CRONS for d in days]
    df = spark.createDataFrame(rows, "c string, d date")
    got = {(r.c, r.d): r.y for r in df.select("c", "d", schedule_due("c", F.col("d")).alias("y")).collect()}
    assert got == {(c, d): fires(c, d) for c, d in rows}


def test_schedule_words(spark):
    d = date(2024, 7, 1)  # a Monday
    cases = {
        "@daily": True, '"@DAILY"': True, "'0 0 * * 1'": True, "@weekly": False, "@monthly": True,
        "@quarterly": True, "@yearly": False, "@once": False, "@never": False, "none": None, "": None,
        "  ": None, "nan": None, '{"_type": "x"}': None, "Dataset:a": None, "every day": None,
        "0 0 * * mon": True, "0 0 * jan,jul *": True, "0 0 * * TUE-FRI": False, "61 0 * * *": None,
        "0 0 32 * *": None, "0 0 * * * *": None, "0 0 ? * 1": True,
    }
    got = column(spark, list(cases), schedule_due("x", F.lit(d)))
    assert dict(zip(cases, got)) == cases
    assert column(spark, [None], schedule_due("x", F.lit(d))) == [None]


# --- scalars --------------------------------------------------------------


def test_labels(spark):
    got = column(spark, [" Failed ", "SUCCESS", "running", None, "upstream_failed"], scalars.failure_label("x"))
    assert got == [1.0, 0.0, None, None, 1.0]


def test_dates_in_names(spark):
    names = ["a/b_20240229.csv", "b_20230229.csv", "b_2024-03-01.md", "b_2024.csv", None]
    assert column(spark, names, scalars.filename_date("x")) == [date(2024, 2, 29), None, date(2024, 3, 1), None, None]
    titles = ["Daily — 2026-06-12", "Daily — 2026-06-12 x", "Daily - 2026-06-12", "Daily —2026-13-01  "]
    assert column(spark, titles, scalars.title_date("x")) == [date(2026, 6, 12), None, None, None]


def test_templates_and_escapes(spark):
    df = spark.createDataFrame([(date(2026, 6, 2),), (None,)], "d date")
    got = [r.y for r in df.select(scalars.expand_template(F.lit("p_{date}_{iso_date}"), "d").alias("y")).collect()]
    assert got == ["p_20260602_2026-06-02", "p_{date}_{iso_date}"]
    assert column(spark, ["<a & 'b' \"c\">"], scalars.escape_html("x")) == ["&lt;a &amp; &#x27;b&#x27; &quot;c&quot;&gt;"]
    assert column(spark, ["a/b.c d"], scalars.state_key("x")) == ["a_b_c_d"]
    assert column(spark, ["é"], scalars.byte_length("x")) == [2]


def test_redaction(spark):
    got = column(spark, ["basic QUJD== x", "u?password=p&os_password=q r"], scalars.redact("x"))
    assert got == ["basic <redacted> x", "u?password=<redacted>&os_password=<redacted> r"]


def test_risk_edges(spark):
    vals = [0.7, 0.4, 0.39, float("nan"), None, float("inf")]
    got = column(spark, vals, scalars.risk_bucket("x", F.lit(0.7), F.lit(0.4)), "double")
    assert got == ["High", "Med", "Low", "Unknown", "Unknown", "Unknown"]
    assert column(spark, [0.42, 0.43, None], scalars.fail_flag("x", 0.42), "double") == [0, 1, 0]


def test_first_action_wins(spark):
    got = column(spark, ["x_timeout|kw_import_error", "avg_queue", "other"], scalars.suggested_action("x"))
    assert got[0].startswith("Validate") and got[1].startswith("Increase timeout") and got[2] == scalars.DEFAULT_ACTION


@pytest.mark.parametrize("all_bad", [False, True])
def test_probability_fallbacks(spark, all_bad):
    nan, inf = float("nan"), float("inf")
    rows = [(0, nan, nan, None), (1, 0.9, 0.1, 1.0), (2, inf, 0.2, 1.0), (3, nan, None, 7.0), (4, 1.5, 0.0, 0.0)]
    if all_bad:
        rows = rows[:1]
    df = spark.createDataFrame(rows, "i int, c double, r double, h double")
    got = [r.p for r in scalars.clean_probabilities(df, "c", "r", "h", "p").orderBy("i").collect()]
    assert got == ([0.5] if all_bad else [pytest.approx(0.95), 0.9, 0.2, 1.0, 1.0])


def test_month_end_and_weekend(spark):
    got = column(
        spark,
        ["2024-02-27 23:00:00", "2024-02-28 01:00:00", "2024-06-30 05:00:00", None],
        F.struct(*[c.alias(n) for n, c in scalars.calendar_columns(F.col("x").cast("timestamp")).items()]),
    )
    assert [tuple(r) for r in got] == [(23, 1, 0, 0), (1, 2, 0, 1), (5, 6, 1, 1), (None, None, None, 0)]
