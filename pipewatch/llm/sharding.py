"""Weighted rendezvous sharding of records by a stable key, in built-in functions only.

Each shard draws a number from the hash of (key, shard); the lowest cost ``-ln(u) / weight``
wins. A key's draw for one shard does not depend on the others, so a new shard takes records
only into itself, about its share of the weight, and no record moves between old shards.

Defined results: a NULL key is one more key value; a NULL text has size 1 and checksum 0;
records that repeat share a shard and get slots of their own; an empty table gives an empty
one; columns other than key and text are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pipewatch.llm.common import whole_text
from pipewatch.session import durable

# Slots are counted inside cells of a shard, so that no task holds a whole shard. The table of
# cell starts has at most shards x CELLS rows of 16 bytes: that bounds what is broadcast.
CELLS = 1024


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of ``key`` among ``len(weights)`` shards, shares in proportion to the weights."""
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("weights must be positive, and there must be one at least")
    bids = []
    for shard, weight in enumerate(weights):
        drawn = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11)
        cost = -F.log((drawn + F.lit(0.5)) * F.lit(2.0**-53)) / F.lit(float(weight))
        bids.append(F.struct(cost.alias("cost"), F.lit(shard).alias("shard")))
    return (F.least(*bids) if len(bids) > 1 else bids[0])["shard"]


def shard_records(
    docs: DataFrame,
    weights: Sequence[float],
    grown: Sequence[float] | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per record: key, ``size``, ``text_crc32``, ``shard``, gapless ``slot``, ``grown_shard``.

    ``grown`` holds the weights after growth (None: one more shard of the mean weight). Only the
    key and two numbers are shuffled, once, by (shard, cell).
    """
    weights = list(weights)
    grown = [*weights, sum(weights) / len(weights)] if grown is None else list(grown)
    body = F.encode(whole_text(text), "UTF-8")
    placed = docs.select(
        F.col(key).alias("record_key"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    # The key alone could be one value for a third of the rows (NULL, say); its cell also
    # depends on the content.
    placed = durable(
        placed.select(
            "*",
            rendezvous(F.col("record_key"), weights).alias("shard"),
            rendezvous(F.col("record_key"), grown).alias("grown_shard"),
            F.pmod(F.xxhash64("record_key", "size", "text_crc32"), F.lit(CELLS)).cast("int").alias("cell"),
        )
    )
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("shard", "cell")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    inside = Window.partitionBy("shard", "cell").orderBy("record_key", "size", "text_crc32")
    return (
        placed.withColumn("place", F.row_number().over(inside) - 1)
        .join(F.broadcast(starts), ["shard", "cell"])
        .select(
            F.col("record_key").alias(key),
            "size",
            "text_crc32",
            "shard",
            (F.col("start") + F.col("place")).alias("slot"),
            "grown_shard",
        )
    )


def write_shards(docs: DataFrame, path: str, weights: Sequence[float], key: str = "doc_id") -> None:
    """The records themselves as one folder per shard; a shard is written by many tasks."""
    spread = F.pmod(F.xxhash64(F.col(key), F.monotonically_increasing_id()), F.lit(CELLS))
    placed = docs.withColumn("shard", rendezvous(F.col(key), weights)).withColumn("_cell", spread)
    placed.repartition("shard", "_cell").drop("_cell").write.partitionBy("shard").parquet(path)
