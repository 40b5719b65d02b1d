"""Point-in-time aggregates without range joins.

Every windowed feature here is a sum over events that a target instant can
"see": an event opens at one instant and closes at another. Writing the opening
as ``+v`` and the closing as ``-v`` turns the window into a running sum over
strictly earlier instants.

The running sum is taken in two levels so that no task ever holds one whole
pipeline: rows are first added up per distinct instant (map-side too), summed
inside short time buckets, and the bucket totals are summed over the buckets of
the key. A bucket of one minute holds at most 6e7 distinct instants and a key
at most 525,600 buckets per year, whatever the skew.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from pipewatch.session import durable
from pipewatch.settings import MINUTE


# Buckets whose totals are summed up together where there is no key: a day of minutes.
BUCKET_GROUP = 1440


def micros(column: Column | str) -> Column:
    """Microseconds since the epoch; session time zone UTC for NTZ columns."""
    c = F.col(column) if isinstance(column, str) else column
    return F.unix_micros(c.cast("timestamp"))


def _exprs(texts: Sequence[str]) -> list[Column]:
    return [F.expr(t) for t in texts]


def _over_buckets(keys: Sequence[str]) -> str:
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    return part + "ORDER BY _bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def _bucketed(df: DataFrame, bucket_us: int) -> DataFrame:
    return df.withColumn("_bucket", F.expr(f"at div {bucket_us}L"))


def _not_null(names: Sequence[str]) -> Column:
    cond = F.lit(True)
    for n in names:
        cond = cond & F.col(n).isNotNull()
    return cond


def strict_prefix_sums(
    deltas: DataFrame,
    targets: DataFrame,
    keys: Sequence[str],
    sums: Sequence[str],
    bucket_us: int = MINUTE,
) -> DataFrame:
    """For each distinct target (keys, at): sums of the deltas with a smaller ``at``.

    ``deltas`` has ``keys``, ``at`` and the ``sums`` columns (NULL counts as 0);
    ``targets`` has ``keys`` and ``at``. Rows with a NULL key or instant take no
    part, so callers left-join the result and fill in what an empty history means.
    """
    keys = list(keys)
    types = {f.name: f.dataType.simpleString() for f in deltas.schema.fields}
    known = " AND ".join(f"{k} IS NOT NULL" for k in [*keys, "at"])
    rows = deltas.selectExpr(*keys, "at", *sums, "0 AS _target").unionAll(
        targets.selectExpr(
            *keys, "at", *[f"CAST(NULL AS {types[v]}) AS {v}" for v in sums], "1 AS _target"
        )
    )
    instants = (
        rows.where(known)
        .selectExpr("*", f"at div {bucket_us}L AS _bucket")
        .groupBy(*keys, "_bucket", "at")
        .agg(*_exprs([*[f"sum({v}) AS {v}" for v in sums], "max(_target) AS _target"]))
    )
    partition = ", ".join([*keys, "_bucket"])
    inside = (
        f"PARTITION BY {partition} ORDER BY at"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    )
    local = instants.selectExpr(
        *keys,
        "_bucket",
        "at",
        "_target",
        *[f"sum({v}) OVER ({inside}) AS {v}" for v in sums],
    ).where("_target = 1")

    # Both branches read the same columns of ``instants``, so its shuffle is reused.
    totals = instants.groupBy(*keys, "_bucket").agg(
        *_exprs([*[f"sum({v}) AS {v}" for v in sums], "max(_target) AS _target"])
    )
    if keys:
        carried = totals.selectExpr(
            *keys, "_bucket", "_target", *[f"sum({v}) OVER ({_over_buckets(keys)}) AS _c_{v}" for v in sums]
        )
    else:
        carried = _carried_by_groups(totals, sums)
    carried = carried.where("_target = 1").drop("_target")
    return local.join(carried, [*keys, "_bucket"], "left").selectExpr(
        *keys, "at", *[f"coalesce({v}, 0) + coalesce(_c_{v}, 0) AS {v}" for v in sums]
    )


def _carried_by_groups(totals: DataFrame, sums: Sequence[str]) -> DataFrame:
    """Sums of all earlier buckets without a key: inside groups of buckets, then over the groups.

    Without a key one window would hold all buckets of history; here it holds one row per group.
    """
    grouped = totals.selectExpr("*", f"_bucket div {BUCKET_GROUP} AS _group")
    inside = "PARTITION BY _group ORDER BY _bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    before = "ORDER BY _group ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    groups = (
        grouped.groupBy("_group")
        .agg(*_exprs([f"sum({v}) AS {v}" for v in sums]))
        .selectExpr("_group", *[f"sum({v}) OVER ({before}) AS _g_{v}" for v in sums])
    )
    local = grouped.selectExpr("_group", "_bucket", "_target", *[f"sum({v}) OVER ({inside}) AS {v}" for v in sums])
    return local.join(groups, "_group").selectExpr(
        "_bucket", "_target", *[f"coalesce({v}, _g_{v}) + IF({v} IS NULL, 0, coalesce(_g_{v}, 0)) AS _c_{v}" for v in sums]
    )


def span_deltas(
    spans: DataFrame,
    keys: Sequence[str],
    opens: Column,
    closes: Column,
    values: dict[str, Column],
) -> DataFrame:
    """``+v`` at ``opens`` and ``-v`` at ``closes`` for spans that are not empty.

    A target at ``t`` sees a span when ``opens < t <= closes``.
    """
    base = spans.select(
        *keys,
        opens.alias("_opens"),
        closes.alias("_closes"),
        *[v.alias(k) for k, v in values.items()],
    ).where("_closes > _opens")
    edges = "inline(array(struct(_opens AS at, 1 AS _sign), struct(_closes AS at, -1 AS _sign)))"
    return base.selectExpr(*keys, *values, edges).selectExpr(
        *keys, "at", *[f"{k} * _sign AS {k}" for k in values]
    )


def trailing_streaks(
    runs: DataFrame,
    targets: DataFrame,
    keys: Sequence[str],
    order: str,
    failed: str,
    bucket_us: int = MINUTE,
) -> DataFrame:
    """Failures since the last run that did not fail, before each target instant.

    ``runs`` has ``keys``, ``at``, a string ``order`` column that ranks runs of one
    instant, and a boolean ``failed``. The streak is the number of earlier runs
    minus the position of the last one that did not fail.
    """
    keys = list(keys)
    at_keys = [*keys, "at"]
    seen = runs.where(_not_null(at_keys)).select(
        *at_keys,
        F.coalesce(F.col(order), F.lit("\uffff")).alias("_order"),
        F.col(failed).alias("_failed"),
    )
    per_instant = seen.groupBy(*at_keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count(F.when(~F.col("_failed"), 1)).alias("_ok"),
        F.max(F.when(~F.col("_failed"), F.col("_order"))).alias("_last_ok"),
    )
    # Only instants with both outcomes need to know which run came last.
    mixed = per_instant.where("_ok > 0 AND _ok < _n").select(*at_keys, "_last_ok")
    tails = (
        seen.where("_failed")
        .join(mixed, at_keys)
        .where("_order > _last_ok")
        .groupBy(*at_keys)
        .agg(F.count(F.lit(1)).alias("_tail"))
    )
    history = per_instant.join(tails, at_keys, "left").select(
        *at_keys,
        "_n",
        F.when(F.col("_ok") > 0, F.coalesce(F.col("_tail"), F.lit(0))).alias("_tail"),
        F.lit(0).alias("_target"),
    )
    marks = targets.where(_not_null(at_keys)).select(
        *at_keys,
        F.lit(0).cast("bigint").alias("_n"),
        F.lit(None).cast("bigint").alias("_tail"),
        F.lit(1).alias("_target"),
    )
    instants = (
        _bucketed(history.unionByName(marks), bucket_us)
        .groupBy(*keys, "_bucket", "at")
        .agg(
            F.sum("_n").alias("_n"),
            F.max("_tail").alias("_tail"),
            F.max("_target").alias("_target"),
        )
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy("at")
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = instants.withColumn(
        "_count", F.coalesce(F.sum("_n").over(before), F.lit(0))
    ).withColumn(
        "_reset",
        F.when(
            F.col("_tail").isNotNull(), F.sum("_n").over(so_far) - F.col("_tail")
        ),
    )
    local = placed.select(
        *keys,
        "_bucket",
        "at",
        "_target",
        "_count",
        F.max("_reset").over(before).alias("_last_reset"),
    ).where("_target = 1")

    across = (
        Window.partitionBy(*keys)
        .orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        placed.groupBy(*keys, "_bucket")
        .agg(
            F.sum("_n").alias("_n"),
            F.max("_reset").alias("_reset"),
            F.max("_target").alias("_target"),
        )
        .withColumn("_count_before", F.coalesce(F.sum("_n").over(across), F.lit(0)))
        .withColumn("_abs", F.col("_count_before") + F.col("_reset"))
        .select(
            *keys,
            "_bucket",
            "_count_before",
            "_target",
            F.max("_abs").over(across).alias("_carry"),
        )
        .where("_target = 1")
        .drop("_target")
    )
    return local.join(carried, [*keys, "_bucket"], "left").select(
        *keys,
        "at",
        (
            F.col("_count_before")
            + F.col("_count")
            - F.coalesce(
                F.greatest(
                    F.col("_carry"), F.col("_count_before") + F.col("_last_reset")
                ),
                F.lit(0),
            )
        ).alias("streak"),
    )


def trailing_quantile(
    events: DataFrame,
    targets: DataFrame,
    keys: Sequence[str],
    value: str,
    q: float,
    window_us: int,
    dense_rows: int = 1_000_000,
    radix_bits: int = 4,
    framed_rows: int = 128,
) -> DataFrame:
    """Exact interpolated quantile of ``value`` over ``[t - window, t)`` per target.

    ``value`` is a whole number (micros). Time is cut into blocks one window long;
    a target needs its own block and the one before. Blocks of few events use the
    built-in ``percentile`` over a range frame, which costs rows x frame. Blocks with
    more than ``framed_rows`` events are one group each, halved by value once per bit
    of its size. Beyond ``dense_rows`` rows a group would be too large for a task;
    there the two neighbouring order statistics are found digit by digit with
    :func:`strict_prefix_sums`. All ways are exact.
    """
    keys = list(keys)
    block_keys = [*keys, "_block"]
    ev = events.where(_not_null([*keys, "at", value])).select(
        *keys, "at", F.col(value).cast("bigint").alias("_v")
    )
    block = F.expr(f"at div {window_us}L")
    tg = (
        targets.where(_not_null([*keys, "at"]))
        .select(*keys, "at")
        .distinct()
        .withColumn("_block", block)
    )
    spread = ev.withColumn(
        "_block",
        F.explode(F.array(block, block + F.lit(1))),
    )
    rows = spread.select(*block_keys, "at", "_v", F.lit(0).alias("_target")).unionByName(
        tg.select(*block_keys, "at", F.lit(None).cast("bigint").alias("_v"), F.lit(1).alias("_target"))
    )
    sizes = durable(
        rows.groupBy(*block_keys)
        .agg(F.count(F.when(F.col("_target") == 0, 1)).alias("_events"), F.count(F.lit(1)).alias("_rows"))
        .where((F.col("_events") > min(framed_rows, dense_rows)) & (F.col("_rows") > F.col("_events")))
        .select(*block_keys, (F.col("_rows") > dense_rows).alias("_dense"))
    )
    kinds = {r["_dense"] for r in sizes.select("_dense").distinct().collect()}
    frame = (
        Window.partitionBy(*block_keys).orderBy("at").rangeBetween(-window_us, -1)
    )
    framed = rows.join(sizes, block_keys, "left_anti") if kinds else rows
    found = (
        framed.withColumn("quantile", F.percentile("_v", q).over(frame))
        .where("_target = 1")
        .select(*keys, "at", "quantile")
    )
    if False in kinds:
        grouped = rows.join(sizes.where("NOT _dense"), block_keys, "left_semi")
        found = found.unionByName(_grouped_quantile(grouped, keys, q, window_us))
    if True not in kinds:
        return found
    dense = sizes.where("_dense").drop("_dense")
    dense_tg = tg.join(dense, block_keys, "left_semi").select(*keys, "at")
    # A dense target sees rows of its own block and of the one before it.
    needed = dense.unionByName(
        dense.withColumn("_block", F.col("_block") - F.lit(1))
    ).distinct()
    dense_ev = (
        ev.withColumn("_block", block)
        .join(needed, block_keys, "left_semi")
        .drop("_block")
    )
    return found.unionByName(
        _digit_search(dense_ev, dense_tg, keys, q, window_us, radix_bits)
    )


def _grouped_quantile(
    rows: DataFrame, keys: list[str], q: float, window_us: int
) -> DataFrame:
    """The quantile of each target row, a block per group; linear times log in its rows."""
    fields = [rows.schema[k] for k in keys]
    schema = StructType([*fields, StructField("at", LongType()), StructField("quantile", DoubleType())])

    def solve(key: tuple, table: pa.Table) -> pa.Table:
        at, target = table["at"].to_numpy(), table["_target"].to_numpy() == 1
        own = np.flatnonzero(~target)
        own = own[np.argsort(at[own], kind="stable")]
        seen, asked = at[own], at[target]
        values = table["_v"].take(pa.array(own)).to_numpy().astype(np.int64)
        first, last = np.searchsorted(seen, asked - window_us), np.searchsorted(seen, asked)
        n = last - first
        position = q * (n - 1.0)
        low, high = np.floor(position), np.ceil(position)
        some = n > 0
        lo, hi = (
            values_at_rank(values, first[some], last[some], r[some].astype(np.int64)).astype(float) for r in (low, high)
        )
        between = (high - position)[some] * lo + (position - low)[some] * hi
        found = np.full(len(asked), np.nan)
        # As the built-in percentile: equal neighbours are not interpolated.
        found[some] = np.where(lo == hi, lo, between)
        same = [pa.repeat(k, len(asked)) for k in key[: len(keys)]]
        columns = [*same, pa.array(asked, pa.int64()), pa.array(found, pa.float64(), mask=~some)]
        return pa.Table.from_arrays(columns, [*keys, "at", "quantile"])

    return rows.groupBy(*keys, "_block").applyInArrow(solve, schema)


def values_at_rank(
    values: np.ndarray, first: np.ndarray, last: np.ndarray, rank: np.ndarray
) -> np.ndarray:
    """For each range ``[first, last)`` of places, the value of a 0-based ``rank`` in it.

    All ranges follow together: the places are split by one bit of the value's overall
    position at a time, zeros before ones, and each range goes to the side of its rank.
    """
    order = np.argsort(values, kind="stable")
    position = np.empty(len(values), np.int64)
    position[order] = np.arange(len(values))
    found = np.zeros(len(rank), np.int64)
    for bit in reversed(range(len(values).bit_length())):
        ones = (position >> bit) & 1 == 1
        zeros_before = np.concatenate([[0], np.cumsum(~ones)])
        a, b = zeros_before[first], zeros_before[last]
        up = rank >= b - a
        found |= up.astype(np.int64) << bit
        rank = np.where(up, rank - (b - a), rank)
        first = np.where(up, zeros_before[-1] + first - a, a)
        last = np.where(up, zeros_before[-1] + last - b, b)
        position = np.concatenate([position[~ones], position[ones]])
    return values[order[found]]


def _digit_search(
    ev: DataFrame,
    tg: DataFrame,
    keys: list[str],
    q: float,
    window_us: int,
    radix_bits: int,
) -> DataFrame:
    bounds = ev.agg(F.min("_v"), F.max("_v")).first()
    low, high = bounds[0], bounds[1]
    levels = max(1, -(-(high - low).bit_length() // radix_bits))
    fan = 1 << radix_bits
    shifted = ev.withColumn("_v", F.col("_v") - F.lit(low))

    counted = strict_prefix_sums(
        span_deltas(
            shifted,
            keys,
            F.col("at"),
            F.col("at") + F.lit(window_us),
            {"_n": F.lit(1).cast("bigint")},
        ),
        tg,
        keys,
        ["_n"],
    )
    position = F.lit(q) * (F.col("_n") - 1)
    # One search per neighbour of the fractional position.
    state = durable(
        counted.where("_n > 0").select(
            *keys,
            "at",
            (position - F.floor(position)).alias("_frac"),
            F.lit(0).cast("bigint").alias("_node"),
            F.explode(
                F.array(
                    F.struct(
                        F.lit("lo").alias("side"), F.floor(position).alias("rank")
                    ),
                    F.struct(
                        F.lit("hi").alias("side"), F.ceil(position).alias("rank")
                    ),
                )
            ).alias("_s"),
        )
    ).select(*keys, "at", "_frac", "_node", "_s.side", "_s.rank")

    digits = [f"_d{i}" for i in range(fan)]
    for level in range(levels):
        shift = (levels - 1 - level) * radix_bits
        tagged = shifted.select(
            *keys,
            "at",
            F.shiftright("_v", shift + radix_bits).alias("_node"),
            F.shiftright("_v", shift).bitwiseAND(F.lit(fan - 1)).alias("_digit"),
        )
        deltas = span_deltas(
            tagged,
            [*keys, "_node"],
            F.col("at"),
            F.col("at") + F.lit(window_us),
            {
                d: F.when(F.col("_digit") == i, 1).otherwise(0).cast("bigint")
                for i, d in enumerate(digits)
            },
        )
        per_digit = strict_prefix_sums(
            deltas, state.select(*keys, "_node", "at"), [*keys, "_node"], digits
        )
        joined = state.join(per_digit, [*keys, "_node", "at"])
        pick = F.lit(None)
        skipped = F.lit(None)
        for i in reversed(range(fan)):
            below = sum((F.col(d) for d in digits[:i]), F.lit(0))
            hit = F.col("rank") < below + F.col(digits[i])
            pick = F.when(hit, F.lit(i)).otherwise(pick)
            skipped = F.when(hit, below).otherwise(skipped)
        state = durable(
            joined.select(
                *keys,
                "at",
                "_frac",
                (F.col("_node") * fan + pick).cast("bigint").alias("_node"),
                "side",
                (F.col("rank") - skipped).alias("rank"),
            )
        )
    lo = F.max(F.when(F.col("side") == "lo", F.col("_node")))
    hi = F.max(F.when(F.col("side") == "hi", F.col("_node")))
    return (
        state.groupBy(*keys, "at", "_frac")
        .agg(lo.alias("_lo"), hi.alias("_hi"))
        .select(
            *keys,
            "at",
            (
                F.lit(low)
                + F.col("_lo")
                + (F.col("_hi") - F.col("_lo")) * F.col("_frac")
            ).alias("quantile"),
        )
    )
