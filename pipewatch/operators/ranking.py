"""Latest versions, first-k per group and exact global positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pipewatch.session import durable

# Spark keeps only the first k rows per group before the shuffle up to this k.
GROUP_LIMIT_MAX = 1000


def _columns(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def latest_version(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """The first row per key in ``order``.

    Each map task already keeps one row per key (``WindowGroupLimit``), so a key
    with very many versions does not travel.
    """
    w = Window.partitionBy(*keys).orderBy(*_columns(order))
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def top_k_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    k: int,
    rank_col: str = "rn",
    salts: int = 64,
) -> DataFrame:
    """The first ``k`` rows per group with their rank from 1.

    Beyond ``GROUP_LIMIT_MAX`` Spark no longer trims before the shuffle; there the
    group is first cut to ``k`` inside ``salts`` slices and then once more.
    """
    cols = _columns(order)
    w = Window.partitionBy(*keys).orderBy(*cols)
    if k > GROUP_LIMIT_MAX:
        names = df.columns
        slices = df.withColumn(
            "_slice", F.pmod(F.xxhash64(*names), F.lit(salts)).cast("int")
        )
        ws = Window.partitionBy(*keys, "_slice").orderBy(*cols)
        df = (
            slices.withColumn("_rs", F.row_number().over(ws))
            .where(F.col("_rs") <= k)
            .select(*names)
        )
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def with_row_index(
    df: DataFrame, order: Sequence[Column | str], index_col: str = "row_index"
) -> DataFrame:
    """Exact 0-based position in the total order, without a one-task sort.

    Spark's range sort splits the rows into balanced, ordered partitions. The sorted
    rows are made durable, so that the partition sizes counted afterwards belong to
    the same split; each row's index is its place in the partition plus the sizes of
    the partitions before it.
    """
    placed = durable(
        df.orderBy(*_columns(order)).withColumn("_id", F.monotonically_increasing_id())
    )
    part = F.shiftright("_id", 33)
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_size"))
        # One row per partition of the sort.
        .select("_part", F.coalesce(F.sum("_size").over(ahead), F.lit(0)).alias("_off"))
    )
    return (
        placed.withColumn("_part", part)
        .join(offsets, "_part")
        .withColumn(
            index_col,
            F.col("_off") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)),
        )
        .drop("_part", "_off", "_id")
    )


def with_group_index(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    index_col: str = "row_no",
) -> DataFrame:
    """Exact 0-based position inside each group, however large the group is."""
    indexed = with_row_index(df, [*keys, *order], "_index")
    first = indexed.groupBy(*keys).agg(F.min("_index").alias("_first"))
    return (
        indexed.join(first, list(keys))
        .withColumn(index_col, F.col("_index") - F.col("_first"))
        .drop("_index", "_first")
    )
