"""Cumulative sums over ordered distinct values, and exact quantiles from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pipewatch.session import durable

# Rows of one piece. Pieces follow the number of rows, and above so many pieces there is another level.
PER_PIECE = 200_000


def cumulative_sums(
    df: DataFrame,
    order: str,
    sums: Sequence[str],
    keys: Sequence[str] = (),
    descending: bool = False,
    per_piece: int | None = None,
) -> DataFrame:
    """``cum_<s>``: sum over this and all earlier values of ``order``.

    ``df`` holds one row per (``keys``, ``order``) and is computed once. The rows are dealt out in ranges of
    about ``per_piece``, summed inside each, and each range's totals are carried to the later ones of its key:
    by a sum over the totals, or where these are many by the same steps again. No task holds all values.
    """
    keys, per_piece = list(keys), per_piece or PER_PIECE
    stored = durable(df)
    pieces = 1 + stored.count() // per_piece
    along = F.col(order).desc() if descending else F.col(order).asc()
    if pieces == 1:
        upto = Window.partitionBy(*keys).orderBy(along).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return stored.select(*df.columns, *[F.sum(s).over(upto).alias(f"cum_{s}") for s in sums])
    # Made durable, so that a row keeps its range. Ranges are numbered along the order.
    ranged = stored.repartitionByRange(pieces, *[F.col(k) for k in keys], along)
    placed = durable(ranged.withColumn("_piece", F.spark_partition_id().cast("long")))
    inside = Window.partitionBy(*keys, "_piece").orderBy(along).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = placed.groupBy(*keys, "_piece").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    if pieces <= per_piece:
        across = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        summed = totals.select("*", *[F.sum(f"_t_{s}").over(across).alias(f"cum__t_{s}") for s in sums])
    else:
        above = totals.withColumnRenamed("_piece", "_at")
        summed = cumulative_sums(above, "_at", [f"_t_{s}" for s in sums], keys, per_piece=per_piece).withColumnRenamed("_at", "_piece")
    carried = summed.select(*keys, "_piece", *[(F.col(f"cum__t_{s}") - F.col(f"_t_{s}")).alias(f"_c_{s}") for s in sums])
    local = placed.select("*", *[F.sum(s).over(inside).alias(f"_l_{s}") for s in sums])
    return local.join(carried, [*keys, "_piece"]).select(
        *df.columns,
        *[(F.col(f"_l_{s}") + F.col(f"_c_{s}")).alias(f"cum_{s}") for s in sums],
    )


def finite(column: Column | str) -> Column:
    """The value as double, NULL when it is NULL, NaN or infinite."""
    c = (F.col(column) if isinstance(column, str) else column).cast("double")
    # Zero times NaN or infinity is not zero.
    return F.when(c * 0.0 == 0.0, c)


def exact_quantiles(
    df: DataFrame, value: str, qs: dict[str, float], keys: Sequence[str] = ()
) -> DataFrame:
    """Linearly interpolated quantiles of the finite values, one row (per key).

    Without keys the row is there even for no values, with NULLs.
    """
    keys = list(keys)
    counts = (
        df.select(*keys, finite(value).alias("_x"))
        .where("_x IS NOT NULL")
        .groupBy(*keys, "_x")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ranked = cumulative_sums(counts, "_x", ["_n"], keys)
    total = ranked.groupBy(*keys).agg(F.max("cum__n").alias("_total"))
    if keys:
        ranked = ranked.join(total, keys)
    else:
        ranked = ranked.withColumn("_total", total.select("_total").scalar())

    def at_rank(rank: Column) -> Column:
        before = F.col("cum__n") - F.col("_n")
        return F.max(
            F.when((before <= rank) & (rank < F.col("cum__n")), F.col("_x"))
        )

    aggs = []
    for name, q in qs.items():
        pos = F.lit(q) * (F.col("_total") - 1)
        lo, hi = F.floor(pos), F.ceil(pos)
        aggs += [
            at_rank(lo).alias(f"_{name}_lo"),
            at_rank(hi).alias(f"_{name}_hi"),
            F.max(pos - lo).alias(f"_{name}_f"),
        ]
    return (
        ranked.groupBy(*keys)
        .agg(*aggs)
        .select(
            *keys,
            *[
                (
                    F.col(f"_{n}_lo")
                    + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * F.col(f"_{n}_f")
                ).alias(n)
                for n in qs
            ],
        )
    )
