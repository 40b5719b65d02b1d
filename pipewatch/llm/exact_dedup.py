"""Exact deduplication by two-pass Bloom filtering, in built-in functions only.

Pass one hashes every text to positions of a bit array and keeps the positions that two or
more rows hit: a Bloom filter of possibly repeated hashes. Pass two tests each row against it.
A row that misses has no equal, so it passes straight through; only rows that hit are shuffled,
by the SHA-256 of their text, and settled exactly. A false hit costs a shuffle, never a result.

Texts are equal when identical after lower-casing A-Z. Defined results: NULL text counts as
empty; of equal texts the row with the largest id stays, a NULL id being smaller than any other;
of rows that also share that id exactly one stays; very long texts are hashed whole; an empty table gives
an empty one; other columns, of any name, come back unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pipewatch.llm.bloom import bit_table, filter_bits, with_hits
from pipewatch.llm.common import ascii_lower, whole_text, with_plain_names
from pipewatch.session import durable

def text_digest(text: str = "text") -> Column:
    """SHA-256 of the normalised text, lower-case hex."""
    return F.sha2(ascii_lower(whole_text(text)), 256)


def with_maybe_repeated(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``_maybe``: false only where no other row has an equal text."""
    bits = filter_bits(docs.count())
    hashed = F.xxhash64(ascii_lower(whole_text(text)))
    repeated = bit_table(docs.select(hashed), bits, at_least=2)
    return with_hits(docs, repeated, bits, hashed, "_maybe")


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    narrow = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    tested = durable(
        with_maybe_repeated(narrow, "_text").select(
            "_key", "_maybe", text_digest("_text").alias("text_sha256"), F.monotonically_increasing_id().alias("_row")
        )
    )
    alone = tested.where(~F.col("_maybe")).select(
        "_key", F.col("_key").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    shuffled = tested.where("_maybe")
    # A hot text is one row of ``groups``. Made durable, it has an exchange of its own in the
    # join, so that adaptive execution can split the hot text's rows on the other side.
    groups = durable(
        shuffled.groupBy("text_sha256").agg(
            F.max(F.struct("_key", "_row")).alias("_keep"), F.count(F.lit(1)).alias("group_size")
        )
    )
    settled = shuffled.join(groups, "text_sha256").select(
        "_key", F.col("_keep._key").alias("keep_id"), "group_size", (F.col("_row") == F.col("_keep._row")).alias("kept"), "text_sha256"
    )
    return alone.unionByName(settled).withColumnRenamed("_key", key)


def drop_exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; only possibly repeated rows are shuffled.

    Each map task sends one row per text, whatever the number of copies. Rows that share text and
    largest id are told apart by their other columns in order, which must be sortable.
    """
    return with_plain_names(docs, _drop, key=key, text=text)


def _drop(docs: DataFrame, key: str, text: str) -> DataFrame:
    names = docs.columns
    tested = with_maybe_repeated(docs, text)
    rest = [c for c in names if c != key]
    row = F.struct(F.col(f"`{key}`").alias("c0"), *[F.col(f"`{c}`").alias(f"c{i + 1}") for i, c in enumerate(rest)])
    settled = (
        tested.where("_maybe")
        .groupBy(text_digest(text).alias("_digest"))
        .agg(F.max(row).alias("_stay"))
        .select(*[F.col(f"_stay.c{i}").alias(c) for i, c in enumerate([key, *rest])])
        .select(*names)
    )
    return tested.where(~F.col("_maybe")).select(*[f"`{c}`" for c in names]).unionByName(settled)
