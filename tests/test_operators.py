"""Running sums, streaks, quantiles and positions against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pipewatch.operators import timeline
from pipewatch.operators.cumulative import cumulative_sums, exact_quantiles
from pipewatch.operators.ranking import (
    latest_version,
    top_k_per_group,
    with_row_index,
)
from pipewatch.operators.timeline import (
    span_deltas,
    strict_prefix_sums,
    trailing_quantile,
    trailing_streaks,
)


def linear(values, q):
    v = sorted(values)
    if not v:
        return None
    p = q * (len(v) - 1)
    lo = int(p)
    hi = min(lo + 1, len(v) - 1)
    return v[lo] + (v[hi] - v[lo]) * (p - lo)


@pytest.fixture(scope="module")
def events():
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        key = "hot" if i % 2 else rnd.choice("abc")
        rows.append((key, rnd.randrange(-50, 300), rnd.randrange(0, 900), f"r{i:04d}", rnd.random() < 0.6))
    rows += [(None, 5, 1, "x1", True), ("a", None, 1, "x2", False)]
    return rows


def frames(spark, events):
    df = spark.createDataFrame(events, "k string, at bigint, v bigint, id string, failed boolean")
    return df, df.select("k", "at").distinct()


def test_span_sums_equal_window_scan(spark, events):
    df, targets = frames(spark, events)
    deltas = span_deltas(df, ["k"], F.col("at"), F.col("at") + 40, {"v": F.col("v")})
    got = {
        (r.k, r["at"]): r.v
        for r in strict_prefix_sums(deltas, targets, ["k"], ["v"], bucket_us=16).collect()
    }
    want = {
        (k, t): sum(v for kk, a, v, *_ in events if kk == k and a is not None and t - 40 <= a < t)
        for k, t, *_ in events
        if k is not None and t is not None
    }
    assert got == want


def test_prefix_without_keys(spark, events):
    df, targets = frames(spark, events)
    got = {
        r["at"]: r.v
        for r in strict_prefix_sums(df.select("at", "v"), targets.select("at"), [], ["v"], 16).collect()
    }
    ok = [(a, v) for _, a, v, *_ in events if a is not None]
    assert got == {t: sum(v for a, v in ok if a < t) for t, _ in ok}


def test_streaks(spark, events):
    df, targets = frames(spark, events)
    got = {
        (r.k, r["at"]): r.streak
        for r in trailing_streaks(df, targets, ["k"], "id", "failed", bucket_us=16).collect()
    }
    want = {}
    for k, t, *_ in events:
        if k is None or t is None:
            continue
        past = sorted((a, i, f) for kk, a, _, i, f in events if kk == k and a is not None and a < t)
        n = 0
        for *_, f in reversed(past):
            if not f:
                break
            n += 1
        want[(k, t)] = n
    assert got == want


@pytest.mark.parametrize("dense_rows", [100000, 60, 0])
def test_trailing_quantile(spark, events, dense_rows):
    df, targets = frames(spark, events)
    got = {
        (r.k, r["at"]): r.quantile
        for r in trailing_quantile(df, targets, ["k"], "v", 0.95, 40, dense_rows).collect()
        if r.quantile is not None
    }
    want = {}
    for k, t, *_ in events:
        if k is None or t is None:
            continue
        x = linear([v for kk, a, v, *_ in events if kk == k and a is not None and t - 40 <= a < t], 0.95)
        if x is not None:
            want[(k, t)] = x
    assert got == pytest.approx(want)


def test_latest_and_top_k(spark):
    rows = [(i % 3, i, i // 2) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, id int, v int")
    order = [F.desc("v"), F.desc("id")]
    assert {(r.k, r.id) for r in latest_version(df, ["k"], order).collect()} == {
        (0, 2997), (1, 2998), (2, 2999)
    }
    for k in (3, 995, 1001):
        got = top_k_per_group(df, ["k"], order, k, salts=4).collect()
        for g in range(3):
            ids = sorted((i for kk, i, _ in rows if kk == g), reverse=True)[:k]
            assert [r.id for r in sorted((r for r in got if r.k == g), key=lambda r: r.rn)] == ids


def test_row_index(spark):
    rnd = random.Random(3)
    rows = [(rnd.randrange(5), i) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(7)
    got = sorted((r.row_index, r.a, r.b) for r in with_row_index(df, ["a", "b"]).collect())
    assert got == [(i, a, b) for i, (a, b) in enumerate(sorted(rows))]


def test_cumulative_and_quantiles(spark):
    rnd = random.Random(5)
    values = [rnd.choice([0.1, 0.25, rnd.random()]) for _ in range(301)]
    df = spark.createDataFrame([(v,) for v in values] + [(float("nan"),), (None,)], "v double")
    row = exact_quantiles(df, "v", {"p50": 0.5, "p70": 0.7, "p90": 0.9}).first()
    for n, q in (("p50", 0.5), ("p70", 0.7), ("p90", 0.9)):
        assert row[n] == pytest.approx(linear(values, q))
    per = {r.k: r.m for r in exact_quantiles(
        df.withColumn("k", F.lit("a")).union(df.withColumn("k", F.lit("b")).limit(100)), "v", {"m": 0.5}, ["k"]
    ).collect()}
    assert per["a"] == pytest.approx(linear(values, 0.5)) and set(per) == {"a", "b"}
    counts = df.where("v >= 0 and not isnan(v)").groupBy("v").agg(F.count("*").alias("n"))
    got = {r.v: r.cum_n for r in cumulative_sums(counts, "v", ["n"], descending=True, per_piece=5).collect()}
    assert got == {v: sum(1 for w in values if w >= v) for v in values}
    empty = exact_quantiles(df.where("v > 9 and not isnan(v)"), "v", {"p": 0.5}).first()
    assert empty.p is None


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("per_piece", [3, 7, 40, 10_000])
def test_cumulative_sums_in_levels(spark, per_piece, descending):
    rnd = random.Random(per_piece)
    # One key has most of the values, one a single one.
    rows = [("hot", v / 4, rnd.randrange(5), rnd.randrange(3)) for v in rnd.sample(range(1000), 300)]
    rows += [("cold", float(v), 1, v % 2) for v in range(20)] + [("one", -1.5, 9, 0)]
    df = spark.createDataFrame(rows, "k string, v double, a long, b long")
    got = {(r.k, r.v): (r.cum_a, r.cum_b) for r in cumulative_sums(df, "v", ["a", "b"], ["k"], descending, per_piece).collect()}
    want, run = {}, {}
    for k, v, a, b in sorted(rows, key=lambda r: r[1], reverse=descending):
        x, y = run.get(k, (0, 0))
        run[k] = want[k, v] = (x + a, y + b)
    assert got == want
    assert cumulative_sums(df.limit(0), "v", ["a"], ["k"], descending, per_piece).count() == 0


def test_a_million_values_stay_in_pieces(spark):
    df = spark.range(1_000_000).select((F.col("id") * 0.5).alias("v"), F.lit(1).cast("long").alias("n"))
    out = cumulative_sums(df, "v", ["n"], per_piece=50_000)
    assert out.where(F.col("cum_n") != F.col("v") * 2 + 1).count() == 0
    sizes = out.groupBy((F.col("cum_n") / 50_000).cast("long")).count()
    plan = out._jdf.queryExecution().executedPlan().toString()
    # The values' windows are over pieces; only the few totals are summed in one.
    assert "_piece" in plan and sizes.count() >= 20


@pytest.mark.parametrize("framed_rows", [2, 50])
def test_quantile_of_large_blocks_needs_no_digit_search(spark, framed_rows, monkeypatch):
    rnd = random.Random(3)
    rows = [("hot", rnd.randrange(-90, 200), rnd.choice([5, 7, rnd.randrange(10**12)])) for _ in range(6000)]
    rows += [("cold", 10 * i, i) for i in range(20)] + [("hot", 20, None)]
    df = spark.createDataFrame(rows, "k string, at bigint, v bigint")

    def refused(*_):
        raise AssertionError("these blocks fit into a group")

    monkeypatch.setattr(timeline, "_digit_search", refused)
    targets = df.select("k", "at").unionByName(spark.createDataFrame([("hot", 5000), ("new", 3)], "k string, at bigint"))
    got = {(r.k, r["at"]): r.quantile for r in trailing_quantile(df, targets, ["k"], "v", 0.95, 100, framed_rows=framed_rows).collect()}
    for k, t in {(r.k, r["at"]) for r in targets.collect()}:
        want = linear([v for kk, a, v in rows if kk == k and v is not None and t - 100 <= a < t], 0.95)
        assert got[k, t] == (None if want is None else pytest.approx(want))


def test_values_at_rank():
    rnd = np.random.default_rng(5)
    for n in (1, 2, 33, 256):
        values = rnd.integers(0, 40, n)
        first = rnd.integers(0, n, 200)
        last = np.array([rnd.integers(a + 1, n + 1) for a in first])
        rank = np.array([rnd.integers(0, b - a) for a, b in zip(first, last)])
        want = [sorted(values[a:b])[r] for a, b, r in zip(first, last, rank)]
        assert timeline.values_at_rank(values, first, last, rank).tolist() == want
