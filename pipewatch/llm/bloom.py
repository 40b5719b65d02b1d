"""Bloom filters as small tables of bitmaps, in built-in functions only.

A hash sets ``PROBES`` bits, each in its own part of the bit array. The array is kept as bitmaps of
32,768 bits by bucket number, so it is built by grouping and tested by a broadcast join whose size
``MAX_BITS`` bounds. More rows than that suits only let more rows pass the test.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pipewatch.session import durable

PROBES = 2
# 32 MB, however many rows there are.
MAX_BITS = 1 << 28
BITS_PER_ROW = 16


def filter_bits(rows: int) -> int:
    bits = 1 << 16
    while bits < BITS_PER_ROW * rows and bits < MAX_BITS:
        bits *= 2
    return bits


def positions(hashed: Column, bits: int) -> Column:
    """The bits of a 64-bit hash, from 1."""
    part = bits // PROBES
    return F.array(*[F.pmod(F.xxhash64(hashed, F.lit(i)), F.lit(part)) + F.lit(i * part + 1) for i in range(PROBES)])


def bit_table(hashes: DataFrame, bits: int, at_least: int = 1) -> DataFrame:
    """The bits that ``at_least`` so many rows of the one column of ``hashes`` set.

    Rows are added up on the map side: one value that a third of them has is one count per task.
    """
    set_bits = hashes.select(F.explode(positions(F.col(hashes.columns[0]), bits)).alias("position"))
    counted = set_bits.groupBy("position").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= at_least)
    return durable(
        counted.groupBy(F.bitmap_bucket_number("position").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("position")).alias("bitmap")
        )
    )


def with_hits(df: DataFrame, table: DataFrame, bits: int, hashed: Column, name: str) -> DataFrame:
    """``df`` plus a boolean: false only where the hash is certainly not in the filter."""
    hit = F.lit(True)
    # Helper columns get names that no column of ``df`` has.
    free = "_" * (1 + max(map(len, df.columns)))
    out = df.withColumn(f"{free}probes", positions(hashed, bits))
    for i in range(PROBES):
        probe = F.col(f"{free}probes")[i]
        # At most bits / 32,768 rows of 4 kB.
        part = F.broadcast(table.select(F.col("bucket").alias(f"{free}bucket{i}"), F.col("bitmap").alias(f"{free}bitmap{i}")))
        out = out.join(part, F.bitmap_bucket_number(probe) == F.col(f"{free}bucket{i}"), "left")
        bit = F.bitmap_bit_position(probe)
        byte = F.conv(F.hex(F.substring(F.col(f"{free}bitmap{i}"), (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        hit = hit & F.coalesce(F.floor(byte / F.pow(F.lit(2), bit % 8)).cast("int") % 2 == 1, F.lit(False))
    return out.select(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns], hit.alias(name))
