"""Metrics, thresholds, risk and report tables, data quality."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from pipewatch.catalog import bindings as b
from pipewatch.catalog import bindings_sql as s
from pipewatch.catalog.scan_queries import IDS, q6, r6
from pipewatch.functions import scalars
from pipewatch.ml import metrics, split
from pipewatch.operators.timeline import micros
from pipewatch.plans import quality, report

QUERIES, ORACLES = {}, {}
P = report.PROB


def add(name, sql=None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


# --- splits ---------------------------------------------------------------

THREE_WAY = f"""labelled AS (SELECT *, CASE state WHEN 'failed' THEN 1 ELSE 0 END AS y FROM order_runs WHERE state IN ('failed', 'success')),
edge AS (SELECT max(at_us) AS newest, count(*) AS n FROM labelled),
timed AS (SELECT l.*, CASE WHEN at_us >= newest - {{t}} * {s.DAY} THEN 'test' WHEN at_us >= newest - ({{t}} + {{v}}) * {s.DAY} THEN 'val' ELSE 'train' END AS split FROM labelled l, edge),
sizes AS (SELECT count(*) FILTER (split = 'train') AS tr, count(*) FILTER (split = 'val') AS va, count(*) FILTER (split = 'test') AS te,
 count(DISTINCT y) FILTER (split = 'train') AS ctr, count(DISTINCT y) FILTER (split = 'val') AS cva, count(*) AS n FROM timed),
ok AS (SELECT tr >= greatest(100, n // 2) AND va >= greatest(30, n // 10) AND te >= greatest(30, n // 10) AND ctr = 2 AND cva = 2 AS good FROM sizes),
placed AS (SELECT l.*, row_number() OVER (ORDER BY at_us, dag_id, run_id) - 1 AS i FROM labelled l),
tagged AS (SELECT t.dag_id, t.run_id, t.at_us, t.y, CASE WHEN good THEN t.split
  WHEN i < CAST(floor(floor(n * 0.8) * 0.8) AS BIGINT) THEN 'train' WHEN i < CAST(floor(n * 0.8) AS BIGINT) THEN 'val' ELSE 'test' END AS split
 FROM timed t JOIN placed p ON t.run_id = p.run_id, ok, edge)"""


def _labelled(spark, sf):
    runs = b.order_runs(spark, sf)
    return runs.withColumn("label_failed", scalars.failure_label("state")).where(
        "label_failed IS NOT NULL"
    )


@add(
    "split_three_way",
    f"WITH {s.ORDER_RUNS}, {THREE_WAY.format(v=300, t=300)} SELECT dag_id, run_id, split FROM tagged",
)
def _(spark, sf):
    return split.three_way_split(_labelled(spark, sf), 300, 300).select(*IDS, "split")


@add(
    "split_positional",
    f"WITH {s.ORDER_RUNS}, {THREE_WAY.format(v=14, t=14)} SELECT dag_id, run_id, split FROM tagged",
)
def _(spark, sf):
    return split.three_way_split(_labelled(spark, sf), 14, 14).select(*IDS, "split")


@add(
    "split_diagnostics",
    f"""WITH {s.ORDER_RUNS}, {THREE_WAY.format(v=300, t=300)}
SELECT split, count(*) AS rows, min(at_us) AS first_us, max(at_us) AS last_us,
 count(*) FILTER (y = 0) AS negatives, count(*) FILTER (y = 1) AS positives FROM tagged GROUP BY split""",
)
def _(spark, sf):
    d = split.split_diagnostics(split.three_way_split(_labelled(spark, sf), 300, 300))
    return d.select(
        "split", "rows", micros("first_date").alias("first_us"), micros("last_date").alias("last_us"),
        "negatives", "positives",
    )


# --- metrics --------------------------------------------------------------

CURVE = f"""{s.SCORED},
by_score AS (SELECT p, CAST(sum(label_failed) AS BIGINT) AS pos, count(*) - CAST(sum(label_failed) AS BIGINT) AS neg FROM scored GROUP BY p),
cum AS (SELECT *, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp FROM by_score WINDOW w AS (ORDER BY p DESC)),
curve AS (SELECT *, CAST(tp AS DOUBLE) / (tp + fp) AS prec, CAST(tp AS DOUBLE) / (SELECT sum(pos) FROM by_score) AS rec FROM cum),
f1 AS (SELECT *, 2 * prec * rec / (prec + rec + 1e-12::DOUBLE) AS f1 FROM curve)"""


@add(
    "pr_curve",
    f"""WITH {CURVE} SELECT p AS threshold, tp, fp, round(prec, 6) AS precision, round(rec, 6) AS recall, round(f1, 6) AS f1 FROM f1""",
)
def _(spark, sf):
    c = metrics.pr_curve(b.scored_rows(spark, sf), "label_failed", P)
    return c.select("threshold", "tp", "fp", *r6("precision", "recall", "f1"))


@add(
    "average_precision",
    f"WITH {CURVE} SELECT round(sum(pos * prec) / sum(pos), 6) AS pr_auc FROM curve",
)
def _(spark, sf):
    return metrics.ranking_metrics(b.scored_rows(spark, sf), "label_failed", P).select(*r6("pr_auc"))


@add(
    "roc_auc",
    f"""WITH {s.SCORED} SELECT round(avg(CASE WHEN a.p > b.p THEN 1.0::DOUBLE WHEN a.p = b.p THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END), 6) AS roc_auc
FROM scored a, scored b WHERE a.label_failed = 1 AND b.label_failed = 0""",
)
def _(spark, sf):
    return metrics.ranking_metrics(b.scored_rows(spark, sf), "label_failed", P).select(*r6("roc_auc"))


@add(
    "best_f1_threshold",
    f"WITH {CURVE} SELECT p AS threshold FROM f1 ORDER BY f1 DESC, p LIMIT 1",
)
def _(spark, sf):
    return metrics.best_f1_threshold(b.scored_rows(spark, sf), "label_failed", P)


CONF = """count(*) FILTER (label_failed = 0 AND NOT p > 0.42) AS tn, count(*) FILTER (label_failed = 0 AND p > 0.42) AS fp,
 count(*) FILTER (label_failed = 1 AND NOT p > 0.42) AS fn, count(*) FILTER (label_failed = 1 AND p > 0.42) AS tp"""


@add(
    "confusion_at_threshold",
    f"""WITH {s.SCORED}, c AS (SELECT {CONF} FROM scored)
SELECT *, round(CAST(tp AS DOUBLE) / greatest(tp + fp, 1), 6) AS precision, round(CAST(tp AS DOUBLE) / greatest(tp + fn, 1), 6) AS recall FROM c""",
)
def _(spark, sf):
    c = metrics.confusion(b.scored_rows(spark, sf), "label_failed", P, 0.42)
    return c.select("tn", "fp", "fn", "tp", *r6("precision", "recall"))


def _split_scores(spark, sf):
    name = F.element_at(F.array(*[F.lit(x) for x in ("train", "val", "test")]), (F.col("run_id").cast("bigint") % 3 + 1).cast("int"))
    return b.scored_rows(spark, sf).withColumn("split", name)


@add(
    "split_metrics",
    f"""WITH {s.SCORED}, t AS (SELECT *, CASE doc_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END AS split FROM scored),
c AS (SELECT split, {CONF} FROM t GROUP BY split),
bs AS (SELECT split, p, sum(label_failed) AS pos, count(*) - sum(label_failed) AS neg FROM t GROUP BY split, p),
cm AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM bs WINDOW w AS (PARTITION BY split ORDER BY p DESC)),
m AS (SELECT split, sum(pos * tp / (tp + fp)) / sum(pos) AS pr_auc, sum(neg * (tp - pos / 2)) / (sum(pos) * sum(neg)) AS roc_auc FROM cm GROUP BY split)
SELECT c.*, 0.42::DOUBLE AS threshold, round(CAST(c.tp AS DOUBLE) / greatest(c.tp + c.fp, 1), 6) AS precision,
 round(CAST(c.tp AS DOUBLE) / greatest(c.tp + c.fn, 1), 6) AS recall, {q6('pr_auc', 'roc_auc', src='m.')}
FROM c JOIN m ON c.split = m.split""",
)
def _(spark, sf):
    e = metrics.evaluate(_split_scores(spark, sf), "label_failed", P, 0.42)
    return e.select("split", "tn", "fp", "fn", "tp", "threshold", *r6("precision", "recall", "pr_auc", "roc_auc"))


@add(
    "class_weight",
    f"""WITH {s.SCORED}, c AS (SELECT count(*) FILTER (label_failed = 0) AS negatives, count(*) FILTER (label_failed = 1) AS positives FROM scored)
SELECT *, round(CAST(negatives AS DOUBLE) / greatest(positives, 1), 6) AS positive_weight FROM c""",
)
def _(spark, sf):
    return metrics.class_weight(b.scored_rows(spark, sf), "label_failed").select(
        "negatives", "positives", *r6("positive_weight")
    )


# --- risk -----------------------------------------------------------------


@add(
    "risk_buckets",
    f"""WITH {s.SCORED} SELECT dag_id, run_id, CASE WHEN p >= 0.7 THEN 'High' WHEN p >= 0.4 THEN 'Med' ELSE 'Low' END AS risk_bucket,
 CAST(p > 0.42 AS INTEGER) AS predicted_fail_flag FROM scored""",
)
def _(spark, sf):
    return report.with_risk(b.scored_rows(spark, sf)).select(*IDS, "risk_bucket", "predicted_fail_flag")


@add(
    "adaptive_thresholds",
    f"""WITH {s.SCORED}, q AS (SELECT quantile_cont(p * 0.3::DOUBLE, 0.7) AS p70, quantile_cont(p * 0.3::DOUBLE, 0.9) AS p90 FROM scored)
SELECT round(greatest(p70 + 1e-6::DOUBLE, p90), 6) AS high, round(p70, 6) AS med FROM q""",
)
def _(spark, sf):
    low = b.scored_rows(spark, sf).withColumn(P, F.col(P) * 0.3)
    return report.adaptive_thresholds(low).select(*r6("high", "med"))


@add(
    "probability_summary",
    f"""WITH {s.SCORED} SELECT round(min(p), 6) AS min, round(quantile_cont(p, 0.5), 6) AS p50, round(quantile_cont(p, 0.9), 6) AS p90,
 round(max(p), 6) AS max, count(*) AS rows FROM scored""",
)
def _(spark, sf):
    return report.probability_summary(b.scored_rows(spark, sf)).select(*r6("min", "p50", "p90", "max"), "rows")


def action_sql(expr):
    arms = " ".join(
        "WHEN " + " OR ".join(f"contains(lower({expr}), '{w}')" for w in words) + f" THEN {s.quote(advice)}"
        for words, advice in scalars.ACTIONS
    )
    return f"CASE {arms} ELSE {s.quote(scalars.DEFAULT_ACTION)} END"


@add(
    "suggested_action",
    f"WITH {s.SCORED} SELECT dag_id, run_id, {action_sql('top_drivers')} AS suggested_action FROM scored",
)
def _(spark, sf):
    return b.scored_rows(spark, sf).select(*IDS, scalars.suggested_action("top_drivers").alias("suggested_action"))


@add(
    "prob_fallback",
    f"""WITH {s.SCORED}, own AS (SELECT *, coalesce(calibrated, raw, CASE WHEN hard IS NOT NULL THEN least(greatest(hard, 0), 1) END) AS o FROM scored),
med AS (SELECT quantile_cont(o, 0.5) AS m FROM own)
SELECT dag_id, run_id, round(least(greatest(coalesce(o, m, 0.5), 0), 1), 6) AS prob FROM own, med""",
)
def _(spark, sf):
    c = scalars.clean_probabilities(b.scored_rows(spark, sf), "calibrated", "raw", "hard", "prob")
    return c.select(*IDS, *r6("prob"))


BUCKET = "CASE WHEN p >= {h} THEN 'High' WHEN p >= 0.4 THEN 'Med' ELSE 'Low' END"


@add(
    "report_top_n",
    f"""WITH {s.SCORED}, r AS (SELECT *, {BUCKET.format(h=0.995)} AS risk_bucket FROM scored),
o AS (SELECT *, row_number() OVER (PARTITION BY risk_bucket = 'High' ORDER BY p DESC, dag_id, run_id) AS rn FROM r)
SELECT dag_id, run_id, risk_bucket FROM o WHERE risk_bucket = 'High' OR rn <= greatest(10 - (SELECT count(*) FROM r WHERE risk_bucket = 'High'), 0)""",
)
def _(spark, sf):
    rows = report.with_risk(b.scored_rows(spark, sf), high=0.995)
    return report.top_rows(rows, 10).select(*IDS, "risk_bucket")


@add(
    "report_top_n_all_high",
    f"""WITH {s.SCORED} SELECT dag_id, run_id, 'High' AS risk_bucket FROM scored WHERE p >= 0.7""",
)
def _(spark, sf):
    return report.top_rows(report.with_risk(b.scored_rows(spark, sf)), 10).select(*IDS, "risk_bucket")


@add(
    "risk_trend",
    f"""WITH {s.SCORED}, c AS (SELECT day, count(*) AS total_runs, count(*) FILTER (p >= 0.7) AS high_risk,
  count(*) FILTER (p >= 0.4 AND p < 0.7) AS med_risk FROM scored GROUP BY day)
SELECT strftime(c.day, '%Y-%m-%d') AS day, c.total_runs, c.high_risk, c.med_risk, y.high_risk AS prev_high_risk, c.high_risk - y.high_risk AS high_risk_change
FROM c LEFT JOIN c y ON y.day = c.day - 1""",
)
def _(spark, sf):
    t = report.risk_trend(report.with_risk(b.scored_rows(spark, sf)), "day")
    return t.withColumn("day", scalars.iso_date("day"))


@add(
    "report_lines",
    f"""WITH {s.SCORED} SELECT dag_id, run_id, '| ' || concat_ws(' | ', dag_id, strftime(day, '%Y-%m-%d') || ' 00:00:00',
 printf('%.3f', p), {BUCKET.format(h=0.7)}, replace(top_drivers, '|', '\\|'), {action_sql('top_drivers')}) || ' |' AS line
FROM scored""",
)
def _(spark, sf):
    rows = report.with_risk(b.scored_rows(spark, sf)).withColumn(
        "suggested_action", scalars.suggested_action("top_drivers")
    ).withColumn("logical_date", F.col("day").cast("timestamp"))
    return report.report_lines(rows).select(*IDS, "line")


@add(
    "report_summary",
    f"""WITH {s.SCORED}, c AS (SELECT count(*) FILTER (day = DATE '2024-01-15') AS total, count(*) FILTER (day = DATE '2024-01-15' AND p >= 0.7) AS high,
 count(*) FILTER (day = DATE '2024-01-14' AND p >= 0.7) AS prev FROM scored)
SELECT '# DAG Failure Risk Report — 2024-01-15' AS title, '- Total runs scored: ' || total AS total_line, '- High-risk runs: ' || high AS high_line,
 '- High-risk count change vs yesterday: ' || CASE WHEN high >= prev THEN '+' ELSE '' END || (high - prev) || ' (' || prev || ' -> ' || high || ')' AS trend_line FROM c""",
)
def _(spark, sf):
    rows = report.with_risk(b.scored_rows(spark, sf))
    now = rows.where("day = DATE '2024-01-15'")
    return report.report_summary(now, rows.where("day = DATE '2024-01-14'"), date(2024, 1, 15))


# --- quality --------------------------------------------------------------


@add(
    "quality_duplicates",
    """SELECT sum(n) AS rows, sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS duplicate_keys FROM
 (SELECT CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""".replace(
        "sum(n)", "CAST(sum(n) AS BIGINT)"
    ).replace("sum(CASE WHEN n > 1 THEN n ELSE 0 END)", "CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT)"),
)
def _(spark, sf):
    return quality.duplicate_summary(b.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@add(
    "quality_null_rates",
    f"""WITH {s.EVENT_LOGS}, c AS (SELECT count(*) AS n, count(task_id) AS a, count(severity) AS b, count(message) AS d, count(full_block) AS e FROM event_logs)
SELECT column_name, round(null_rate, 6) AS null_rate FROM (
 SELECT 'task_id' AS column_name, 1 - CAST(a AS DOUBLE) / n AS null_rate FROM c UNION ALL SELECT 'severity', 1 - CAST(b AS DOUBLE) / n FROM c
 UNION ALL SELECT 'message', 1 - CAST(d AS DOUBLE) / n FROM c UNION ALL SELECT 'full_block', 1 - CAST(e AS DOUBLE) / n FROM c
 UNION ALL SELECT unnest(['dag_id', 'run_id', 'try_number', 'log_ts', 'source_loc']), 0.0::DOUBLE)""",
)
def _(spark, sf):
    return quality.null_rates(b.event_logs(spark, sf)).select("column_name", *r6("null_rate"))


@add("label_histogram", "SELECT quality, toxic, count(*) AS n FROM labels GROUP BY ALL")
def _(spark, sf):
    labels = b.table(spark, sf, "labels")
    return labels.groupBy("quality", "toxic").agg(F.count(F.lit(1)).alias("n"))


@add(
    "state_histogram",
    f"WITH {s.ORDER_RUNS} SELECT state, count(*) AS n FROM order_runs GROUP BY state",
)
def _(spark, sf):
    return quality.value_histogram(b.order_runs(spark, sf), "state")


_PROFILE = ["calibrated", "raw", "hard", "quality"]


@add(
    "column_profile",
    f"WITH {s.SCORED} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) + {extra} AS missing, round(min({c}), 6) AS min_value, round(max({c}), 6) AS max_value, round(avg({c}), 6) AS mean_value FROM scored"
        for c, extra in (("hard", "0"), ("quality", "0"), ("p", "0"))
    ),
)
def _(spark, sf):
    df = b.scored_rows(spark, sf).withColumn("p", F.col(P))
    prof = quality.column_profile(df, ["hard", "quality", "p"])
    return prof.select("column_name", "row_count", "missing", *r6("min_value", "max_value", "mean_value"))


REDACT_TEXT = "concat('GET /x?user=', user_id, '&password=s', event_id, '&api-token=t', event_id, ' Authorization: basic QUJD', event_id, '== done ', event_type)"


@add(
    "redact",
    f"""SELECT event_id, regexp_replace(regexp_replace({REDACT_TEXT}, '(Basic\\s+)[A-Za-z0-9+/=]+', '\\1<redacted>', 'gi'),
 '([?&](?:password|os_password|auth_token|api_token|api-token)=)[^&\\s]+', '\\1<redacted>', 'gi') AS message FROM events""",
)
def _(spark, sf):
    e = b.table(spark, sf, "events")
    i = F.col("event_id").cast("string")
    raw = F.concat(
        F.lit("GET /x?user="), F.col("user_id").cast("string"), F.lit("&password=s"), i, F.lit("&api-token=t"), i,
        F.lit(" Authorization: basic QUJD"), i, F.lit("== done "), F.col("event_type"),
    )
    return e.select("event_id", scalars.redact(raw).alias("message"))
