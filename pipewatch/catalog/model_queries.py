"""Models. What is fitted by Spark has no SQL counterpart; preparation, calibration, fixed models' scores,
drivers and swaps do."""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from pipewatch.catalog import bindings as b
from pipewatch.catalog import scan_queries as sq
from pipewatch.catalog.scan_queries import CFG, IDS, TARGET_DAY, order_frame
from pipewatch.ml import compiled, explain, fit, isotonic, prep, score
from pipewatch.ml.trees import LinearScorer, TreeScorer, vector_parts
from pipewatch.operators.ranking import with_row_index
from pipewatch.plans import features as ft
from pipewatch.session import durable

QUERIES, ORACLES = {}, {}
# The orders span years.
SPLIT = {"val_days": 300, "test_days": 300}
_models: dict = {}
_frames: dict = {}


def add(name, sql=None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return keep


def _frame(spark, sf):
    """The training frame, written once per session and folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _frames:
        _frames[key] = durable(order_frame(spark, sf))
    return _frames[key]


def trained(spark, sf, boosted):
    """(bundle, scored frame), fitted once per session and folder."""
    key = (spark.sparkContext.applicationId, sf, boosted)
    if key not in _models:
        frame = _frame(spark, sf)
        _models[key] = fit.train(frame, boosted=boosted, **SPLIT)
    return _models[key]


def _scores(spark, sf, boosted):
    _bundle, scored = trained(spark, sf, boosted)
    return scored.select(*IDS, "split", "label_failed", F.round("raw", 6).alias("raw"))


@add("gbt_scores")
def _(spark, sf):
    return _scores(spark, sf, True)


@add("lr_scores")
def _(spark, sf):
    return _scores(spark, sf, False)


@add("calibrated_scores")
def _(spark, sf):
    _bundle, scored = trained(spark, sf, True)
    return scored.select(*IDS, "split", F.round("calibrated", 6).alias("calibrated"), F.round(fit.PROB, 6).alias("prob"))


@add("training_metrics")
def _(spark, sf):
    return fit.training_metrics(*trained(spark, sf, True))


@add("permutation_importance")
def _(spark, sf):
    bundle, scored = trained(spark, sf, True)
    return explain.permutation_importance(
        scored.where("split = 'test'"), bundle.model, bundle.preprocessor.slot_table()
    )


@add("top_drivers")
def _(spark, sf):
    bundle, scored = trained(spark, sf, True)
    return explain.with_top_drivers(scored, bundle.model, bundle.preprocessor.names_of, width=bundle.preprocessor.size).select(*IDS, "top_drivers")


@add("lr_top_drivers")
def _(spark, sf):
    bundle, scored = trained(spark, sf, False)
    return explain.with_top_drivers(scored, bundle.model, bundle.preprocessor.names_of, width=bundle.preprocessor.size).select(*IDS, "top_drivers")


@add("predictions")
def _(spark, sf):
    bundle, _scored = trained(spark, sf, True)
    runs = b.order_runs(spark, sf)
    frame = ft.inference_frame(
        TARGET_DAY, runs, b.order_tasks(spark, sf), b.customer_pipelines(spark, sf), None, CFG
    )
    return score.predict(bundle, frame, b.order_logs(spark, sf), runs)


@add("candidate_metrics")
def _(spark, sf):
    """A row per setting of the whole grid."""
    bundle, _scored = trained(spark, sf, True)
    names = "candidate, max_depth, learning_rate, subsample, colsample, n_estimators, best_round, fitted_rounds, val_loss, val_pr_auc"
    kinds = "long long double double double long long long double double".split()
    columns = names.split(", ")
    rows = [tuple(r[c] for c in columns) for r in bundle.tried]
    return spark.createDataFrame(rows, ", ".join(f"{c} {k}" for c, k in zip(columns, kinds)))


# --- preparation ------------------------------------------------------------

NUMERIC = [
    *sq.RATE_COLS, *sq.COUNT_COLS, *sq.DUR_COLS, "consecutive_failures", *sq.TASK_COLS, *sq.PRESSURE_COLS, *sq.CAL_COLS,
    "dag_last_parsed_age_hours", *sq.FACT_COLS[:-3], *sq.FRAME_SAMPLE,
]
LABELLED = ["run_type", *sq.FACT_COLS[-3:]]


def _slots_sql():
    frame = sq.ORACLES["feature_frame"]
    number = {c: i for i, c in enumerate([*NUMERIC, *LABELLED])}
    medians = ", ".join(f"median({c}::DOUBLE) AS {c}" for c in NUMERIC)
    modes = ", ".join(f"(SELECT {c} FROM f WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS {c}" for c in LABELLED)
    cells = []
    for c in NUMERIC:
        cells.append(f"SELECT dag_id, run_id, 0 AS kind, {number[c]} AS ord, '' AS label, 'num__{c}' AS feature, coalesce(f.{c}::DOUBLE, m.{c}) AS value FROM f, m")
    for c in [*NUMERIC, *LABELLED]:
        cells.append(f"SELECT dag_id, run_id, 1, {number[c]}, '', 'miss__{c}', ({c} IS NULL)::INT::DOUBLE FROM f")
    for c in LABELLED:
        cells.append(f"SELECT dag_id, run_id, 2, {number[c]}, v, 'cat__{c}_' || v, 1.0 FROM (SELECT dag_id, run_id, coalesce(f.{c}, o.{c}) AS v FROM f, o)")
    # A numeric column without a value has no slot, a flag one only where values are missing.
    empty = ", ".join(f"count({c}) AS {c}" for c in [*NUMERIC, *LABELLED])
    return f"""WITH f AS MATERIALIZED ({frame}),
m AS (SELECT {medians} FROM f), o AS (SELECT {modes}), n AS (SELECT {empty} FROM f),
filled AS (SELECT name, n_values FROM (UNPIVOT n ON COLUMNS(*) INTO NAME name VALUE n_values)),
cells AS MATERIALIZED ({' UNION ALL '.join(cells)}),
slots AS (SELECT kind, ord, label, feature, row_number() OVER (ORDER BY kind, ord, label) - 1 AS slot FROM (
  SELECT DISTINCT kind, ord, label, feature FROM cells JOIN filled ON n_values > 0 AND (feature = 'num__' || name OR feature = 'miss__' || name OR (kind = 2 AND starts_with(feature, 'cat__' || name || '_')))
  WHERE kind <> 1 OR value > 0))
SELECT dag_id, run_id, slot, feature, round(value, 6) AS value FROM cells JOIN slots USING (kind, ord, label, feature) WHERE value <> 0"""


@add("preprocessed_slots", _slots_sql())
def _(spark, sf):
    frame = durable(sq._frame_view(_frame(spark, sf)))
    fitted = prep.fit_preprocessor(frame, [*NUMERIC, *LABELLED])
    rows = fitted.sparse_rows(frame, IDS)
    return rows.withColumn("value", F.round("value", 6))


# --- calibration ------------------------------------------------------------

# Scores of three digits, so that many rows share one.
_ISO_POINTS = "SELECT round(l_extendedprice / 110000, 3) AS score, (l_returnflag = 'R')::INT::DOUBLE AS y FROM lineitem"


@add(
    "isotonic_fit",
    f"""WITH p AS (SELECT score, count(*)::DOUBLE AS weight, sum(y) AS positives FROM ({_ISO_POINTS}) GROUP BY score),
c AS (SELECT *, row_number() OVER (ORDER BY score) AS i, sum(weight) OVER (ORDER BY score) AS cw, sum(positives) OVER (ORDER BY score) AS cp FROM p),
a AS (SELECT s.i AS a, e.i AS b, (e.cp - s.cp + s.positives) / (e.cw - s.cw + s.weight) AS mean FROM c s JOIN c e ON e.i >= s.i),
low AS (SELECT a, b, min(mean) OVER (PARTITION BY a ORDER BY b DESC) AS least FROM a),
fit AS (SELECT b AS i, max(least) AS fitted FROM low GROUP BY b)
SELECT score, weight, positives, round(fitted, 9) AS fitted FROM c JOIN fit USING (i)""",
)
def _(spark, sf):
    lines = b.table(spark, sf, "lineitem").select(
        F.round(F.col("l_extendedprice").cast("double") / 110000, 3).alias("score"), (F.col("l_returnflag") == "R").cast("double").alias("y")
    )
    # Small ranges, so that blocks are merged across several of them.
    fitted = isotonic.isotonic_fit(isotonic.score_points(lines, "score", "y"), per_piece=100, fan_in=3)
    return fitted.withColumn("fitted", F.round("fitted", 9))


# --- fixed models -----------------------------------------------------------


def _node(tree, i, left, right, slot, cut, value, cover):
    split = {"featureIndex": slot, "numCategories": -1, "leftCategoriesOrThreshold": [cut]}
    return {"treeID": tree, "id": i, "leftChild": left, "rightChild": right, "split": split, "prediction": value, "impurityStats": [cover]}


# Two trees over quantity, price and discount.
TREES = TreeScorer.from_rows(
    [
        _node(0, 0, 1, 4, 0, 24.0, 0.0, 100), _node(0, 1, 2, 3, 1, 30000.0, 0.0, 40), _node(0, 2, -1, -1, -1, 0, 0.8, 25),
        _node(0, 3, -1, -1, -1, 0, -0.2, 15), _node(0, 4, 5, 6, 2, 0.05, 0.0, 60), _node(0, 5, -1, -1, -1, 0, -0.5, 30),
        _node(0, 6, -1, -1, -1, 0, 0.3, 30), _node(1, 0, 1, 4, 2, 0.03, 0.0, 100), _node(1, 1, 2, 3, 0, 10.0, 0.0, 50),
        _node(1, 2, -1, -1, -1, 0, 0.4, 10), _node(1, 3, -1, -1, -1, 0, -0.1, 40), _node(1, 4, -1, -1, -1, 0, 0.25, 50),
    ],
    [1.0, 0.5],
)
LINE = LinearScorer(np.array([0.04, -0.0001, 6.0]), -0.5)
LINE_MEANS = [25.0, 38000.0, 0.05]
INPUTS = ["l_quantity", "l_extendedprice", "l_discount"]
LINE_KEYS = ["l_orderkey", "l_linenumber"]


def _scored_lines(spark, sf, scorer, means=()):
    lines = b.table(spark, sf, "lineitem")
    parts = compiled.contribution_columns(scorer, lambda s: F.col(INPUTS[s]).cast("double"), means)
    margin = compiled.margin_column(scorer, lambda s: F.col(INPUTS[s]).cast("double"))
    return lines.select(
        *LINE_KEYS,
        F.round(margin, 6).alias("margin"),
        F.round(compiled.probability_column(scorer, margin), 6).alias("probability"),
        *[F.round(parts[i], 6).alias(f"phi_{c}") for i, c in enumerate(INPUTS)],
        compiled.top_drivers_column(parts, INPUTS, 2).alias("top_drivers"),
    )


def _known(known):
    """The trees' mean when only some inputs are known, written out by hand."""
    q, p, d = known
    one = f"({'(q <= 24)::INT' if q else '0.4'})"
    two = f"({'(p <= 30000)::INT' if p else '0.625'})"
    three = f"({'(d <= 0.05)::INT' if d else '0.5'})"
    four = f"({'(d <= 0.03)::INT' if d else '0.5'})"
    five = f"({'(q <= 10)::INT' if q else '0.2'})"
    return (
        f"({one} * ({two} * 0.8 + (1 - {two}) * -0.2) + (1 - {one}) * ({three} * -0.5 + (1 - {three}) * 0.3)"
        f" + 0.5 * ({four} * ({five} * 0.4 + (1 - {five}) * -0.1) + (1 - {four}) * 0.25))::DOUBLE"
    )


def _phi_sql(j):
    terms = []
    for others in itertools.product((0, 1), repeat=2):
        with_j, without = (list(others), list(others))
        with_j.insert(j, 1)
        without.insert(j, 0)
        weight = "6.0" if sum(others) == 1 else "3.0"
        terms.append(f"({_known(with_j)} - {_known(without)}) / {weight}")
    return " + ".join(terms)


def _drivers_sql(base):
    sized = ", ".join(f"{{'size': -round(abs(phi_{c}), 9), 'slot': {i}, 'name': '{c}'}}" for i, c in enumerate(INPUTS))
    return f"""SELECT l_orderkey, l_linenumber, round(margin, 6) AS margin, round(probability, 6) AS probability,
  {', '.join(f'round(phi_{c}, 6) AS phi_{c}' for c in INPUTS)},
  array_to_string(list_transform(list_sort([{sized}])[1:2], lambda z: z.name), '|') AS top_drivers FROM ({base})"""


_LINES = "SELECT l_orderkey, l_linenumber, l_quantity::DOUBLE AS q, l_extendedprice::DOUBLE AS p, l_discount::DOUBLE AS d FROM lineitem"


@add(
    "compiled_tree_drivers",
    _drivers_sql(
        f"""SELECT *, 1 / (1 + exp(-2 * margin)) AS probability FROM (SELECT *, {_known((1, 1, 1))} AS margin,
  {', '.join(f'{_phi_sql(j)} AS phi_{c}' for j, c in enumerate(INPUTS))} FROM ({_LINES}))"""
    ),
)
def _(spark, sf):
    return _scored_lines(spark, sf, TREES)


@add(
    "compiled_linear_drivers",
    _drivers_sql(
        f"""SELECT *, 1 / (1 + exp(-margin)) AS probability FROM (SELECT *, -0.5::DOUBLE + 0.04::DOUBLE * q - 0.0001::DOUBLE * p + 6.0::DOUBLE * d AS margin,
  (q - 25) * 0.04::DOUBLE AS phi_l_quantity, (p - 38000) * -0.0001::DOUBLE AS phi_l_extendedprice, (d - 0.05::DOUBLE) * 6.0::DOUBLE AS phi_l_discount
  FROM ({_LINES}))"""
    ),
)
def _(spark, sf):
    return _scored_lines(spark, sf, LINE, LINE_MEANS)


# A fixed permutation: the partner of a row is some places ahead, another distance for each repeat.
STEPS = (17, 101, 1009)
_SWAP = LinearScorer(np.array([1.3, -0.45, 0.1]), -1.0)


@add(
    "swap_importance",
    f"""WITH r AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS i, (o_orderstatus = 'F')::INT AS y,
  o_totalprice::DOUBLE / 100000 AS a, (o_custkey % 7)::DOUBLE AS b, (o_orderkey % 5)::DOUBLE AS c FROM orders),
p AS (SELECT r.*, step, q.a AS pa, q.b AS pb, q.c AS pc FROM r, (SELECT unnest({list(STEPS)}) AS step), (SELECT count(*) AS n FROM r)
  JOIN r AS q ON q.i = (r.i + step) % n),
h AS (SELECT step, avg(((1.3::DOUBLE * a - 0.45::DOUBLE * b + 0.1::DOUBLE * c - 1 > 0)::INT = y)::INT) AS base,
  avg(((1.3::DOUBLE * pa - 0.45::DOUBLE * b + 0.1::DOUBLE * c - 1 > 0)::INT = y)::INT) AS s0,
  avg(((1.3::DOUBLE * a - 0.45::DOUBLE * pb + 0.1::DOUBLE * c - 1 > 0)::INT = y)::INT) AS s1,
  avg(((1.3::DOUBLE * a - 0.45::DOUBLE * b + 0.1::DOUBLE * pc - 1 > 0)::INT = y)::INT) AS s2 FROM p GROUP BY step)
SELECT slot, round(avg(lost), 9) AS importance_mean, round(stddev_pop(lost), 9) AS importance_std FROM (
  SELECT 0 AS slot, base - s0 AS lost FROM h UNION ALL SELECT 1, base - s1 FROM h UNION ALL SELECT 2, base - s2 FROM h) GROUP BY slot""",
)
def _(spark, sf):
    orders = b.table(spark, sf, "orders").select(
        "o_orderkey",
        (F.col("o_orderstatus") == "F").cast("double").alias("y"),
        vector_parts(
            array_to_vector(
                F.array(F.col("o_totalprice").cast("double") / 100000, (F.col("o_custkey") % 7).cast("double"), (F.col("o_orderkey") % 5).cast("double"))
            )
        ).alias("own"),
    )
    rows = durable(with_row_index(orders, ["o_orderkey"], "i"))
    n = rows.count()
    ahead = rows.select(F.col("i").alias("_at"), F.col("own").alias("partner"))
    repeats = F.explode(F.array(*[F.struct(F.lit(r).alias("repeat"), F.lit(s).alias("step")) for r, s in enumerate(STEPS)]))
    pairs = rows.withColumn("_r", repeats).withColumn("_at", (F.col("i") + F.col("_r.step")) % n).join(ahead, "_at")
    hits = explain.swap_hits(pairs.select(F.col("_r.repeat").alias("repeat"), "y", "own", "partner"), _SWAP, "y")
    lost = explain.importance_of(hits)
    return lost.select("slot", F.round("importance_mean", 9).alias("importance_mean"), F.round("importance_std", 9).alias("importance_std"))
