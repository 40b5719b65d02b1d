"""Written and read again: ordered tables, typed texts, days of predictions; and how columns are prepared."""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.sql import functions as F

from pipewatch.catalog import bindings as b
from pipewatch.catalog import bindings_sql as s
from pipewatch.catalog.log_queries import FAILED_SQL
from pipewatch.catalog.scan_queries import IDS
from pipewatch.catalog.score_queries import _labelled
from pipewatch.functions import scalars
from pipewatch.ml import split
from pipewatch.operators.ranking import with_group_index, with_row_index
from pipewatch.plans import rca, report
from pipewatch.session import shared_folder
from pipewatch.sources import artefacts, typed

QUERIES, ORACLES = {}, {}
P = report.PROB


def add(name, sql):
    def keep(fn):
        QUERIES[name], ORACLES[name] = fn, sql
        return fn

    return keep


def _folder(spark):
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


# --- order ------------------------------------------------------------------


@add(
    "ordered_frame",
    f"WITH {s.ORDER_RUNS} SELECT dag_id, run_id, row_number() OVER (ORDER BY at_us, dag_id, run_id) - 1 AS place FROM order_runs",
)
def _(spark, sf):
    return with_row_index(b.order_runs(spark, sf).select("logical_date", *IDS), ["logical_date", *IDS], "place").select(*IDS, "place")


@add(
    "ordered_predictions",
    f"WITH {s.SCORED} SELECT dag_id, run_id, row_number() OVER (ORDER BY p DESC, dag_id, run_id) - 1 AS place FROM scored",
)
def _(spark, sf):
    """Predictions as a sorted artefact, read back in the order of its files."""
    root = _folder(spark)
    artefacts.write_artefact(b.scored_rows(spark, sf).select(*IDS, P), root, "predictions.csv", [F.desc(P), *IDS])
    rows = artefacts.numbered_csv(artefacts.read_csv(spark, f"{root}/predictions.csv"), "_file", "_at")
    one = rows.withColumn("_of", F.lit(0))
    return with_group_index(one, ["_of"], ["_file", "_at"], "place").select(*IDS, "place")


@add(
    "failed_run_ranked",
    f"""WITH {s.EVENT_LOGS}, {FAILED_SQL} SELECT dag_id, run_id,
 row_number() OVER (ORDER BY CASE worst_severity WHEN 'CRITICAL' THEN 1 ELSE 0 END DESC, log_count DESC, latest_log_ts DESC, dag_id, run_id) - 1 AS place
 FROM failed""",
)
def _(spark, sf):
    summary = rca.failed_run_report(b.event_logs(spark, sf), date(2024, 1, 20), 7)
    return with_row_index(summary, rca.failed_run_order(), "place").select(*IDS, "place")


# --- reading ------------------------------------------------------------------

_TEXTS_SQL = """texts AS (SELECT o_orderkey,
 CASE o_orderkey % 5 WHEN 0 THEN 'n/a' WHEN 1 THEN '' WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') || 'x'
  ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS seen_at,
 CASE o_orderkey % 7 WHEN 0 THEN '12,5' WHEN 1 THEN NULL WHEN 2 THEN o_orderpriority ELSE CAST(o_orderkey AS VARCHAR) END AS amount FROM orders)"""
_KINDS = {"seen_at": "timestamp", "amount": "number"}


def _texts(spark, sf):
    """Orders as a CSV with texts that are no dates and no numbers among them, read back."""
    key, at = F.col("o_orderkey"), F.col("o_orderdate")
    seen = (
        F.when(key % 5 == 0, "n/a").when(key % 5 == 1, "").when(key % 5 == 2, F.concat(F.date_format(at, "yyyy-MM-dd"), F.lit("x")))
    ).otherwise(F.date_format(at, "yyyy-MM-dd HH:mm:ss"))
    amount = F.when(key % 7 == 0, "12,5").when(key % 7 == 1, None).when(key % 7 == 2, F.col("o_orderpriority")).otherwise(key.cast("string"))
    root = _folder(spark)
    rows = b.table(spark, sf, "orders").select("o_orderkey", seen.alias("seen_at"), amount.alias("amount"))
    artefacts.write_artefact(rows, root, "orders.csv", ["o_orderkey"])
    back = artefacts.read_csv(spark, f"{root}/orders.csv")
    return back.withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


@add(
    "rejected_rows",
    f"""WITH {_TEXTS_SQL}
SELECT o_orderkey, 'seen_at' AS column_name, seen_at AS value, 'no timestamp' AS reason FROM texts
WHERE trim(seen_at) <> '' AND try_cast(seen_at AS TIMESTAMP) IS NULL
UNION ALL SELECT o_orderkey, 'amount', amount, 'no number' FROM texts WHERE trim(amount) <> '' AND try_cast(amount AS DOUBLE) IS NULL""",
)
def _(spark, sf):
    return typed.rejected_rows(_texts(spark, sf), ["o_orderkey"], _KINDS)


@add(
    "typed_rows",
    f"WITH {_TEXTS_SQL} SELECT o_orderkey, epoch_us(try_cast(seen_at AS TIMESTAMP)) AS seen_us, try_cast(amount AS DOUBLE) AS amount FROM texts",
)
def _(spark, sf):
    rows = typed.typed_rows(_texts(spark, sf), _KINDS)
    return rows.select("o_orderkey", F.unix_micros("seen_at").alias("seen_us"), "amount")


_DAYS = (date(2024, 1, 11), date(2024, 1, 12))


@add(
    "two_days_predictions",
    f"""WITH {s.SCORED} SELECT CASE day WHEN DATE '{_DAYS[1]}' THEN 'day' ELSE 'day before' END AS part, dag_id, run_id, p AS {P} FROM scored
WHERE day IN (DATE '{_DAYS[0]}', DATE '{_DAYS[1]}')""",
)
def _(spark, sf):
    """Each day's predictions replace that day only; a day and the one before are read."""
    path = f"{_folder(spark)}/predictions"
    rows = b.scored_rows(spark, sf).select(*IDS, P, "day")
    for day in (*_DAYS, _DAYS[1] + timedelta(days=1), _DAYS[1]):
        artefacts.write_dated(rows.where(F.col("day") == F.lit(day)).drop("day"), path, day)
    now, before = artefacts.read_with_previous_day(spark, path, _DAYS[1], rows.drop("day").schema)
    return now.withColumn("part", F.lit("day")).unionByName(before.withColumn("part", F.lit("day before")))


# --- preparation --------------------------------------------------------------


@add(
    "finite_values",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber IN (1, 2, 3) THEN NULL ELSE l_extendedprice END AS price FROM lineitem""",
)
def _(spark, sf):
    line, price = F.col("l_linenumber"), F.col("l_extendedprice")
    odd = F.when(line == 1, F.lit(float("inf"))).when(line == 2, F.lit(float("-inf"))).when(line == 3, F.lit(float("nan"))).otherwise(price)
    rows = b.table(spark, sf, "lineitem").withColumn("odd", odd)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", scalars.null_if_infinite("odd").alias("price"))


_PLAN_COLUMNS = ("o_orderkey", "o_totalprice", "odd_price", "no_price")


@add(
    "empty_columns",
    """WITH o AS (SELECT *, CASE WHEN o_orderkey % 2 = 1 THEN o_totalprice END AS odd_price, CASE WHEN o_totalprice < 0 THEN o_totalprice END AS no_price FROM orders),
n AS (SELECT count(o_orderkey) AS o_orderkey, count(o_totalprice) AS o_totalprice, count(odd_price) AS odd_price, count(no_price) AS no_price FROM o)
SELECT name FROM (UNPIVOT n ON COLUMNS(*) INTO NAME name VALUE filled) WHERE filled = 0""",
)
def _(spark, sf):
    price = F.col("o_totalprice")
    rows = b.table(spark, sf, "orders").withColumn("odd_price", F.when(F.col("o_orderkey") % 2 == 1, price)).withColumn("no_price", F.when(price < 0, price))
    return spark.createDataFrame([(c,) for c in split.all_null_columns(rows, _PLAN_COLUMNS)], "name string")


@add(
    "split_two_way",
    f"""WITH {s.ORDER_RUNS}, labelled AS (SELECT *, CASE state WHEN 'failed' THEN 1 ELSE 0 END AS y FROM order_runs WHERE state IN ('failed', 'success')),
edge AS (SELECT max(at_us) AS newest, count(*) AS n FROM labelled),
timed AS (SELECT l.*, CASE WHEN at_us >= newest - 300 * {s.DAY} THEN 'test' ELSE 'train' END AS split FROM labelled l, edge),
ok AS (SELECT count(*) FILTER (split = 'train') >= greatest(100, CAST(floor(count(*) * 0.2) AS BIGINT)) AND count(*) FILTER (split = 'test') > 0
 AND count(DISTINCT y) FILTER (split = 'train') = 2 AS good FROM timed),
placed AS (SELECT run_id, row_number() OVER (ORDER BY at_us, dag_id, run_id) - 1 AS i FROM labelled)
SELECT t.dag_id, t.run_id, CASE WHEN good THEN t.split WHEN i < CAST(floor(n * 0.8) AS BIGINT) THEN 'train' ELSE 'test' END AS split
FROM timed t JOIN placed p ON t.run_id = p.run_id, ok, edge""",
)
def _(spark, sf):
    return split.two_way_split(_labelled(spark, sf), 300).select(*IDS, "split")
