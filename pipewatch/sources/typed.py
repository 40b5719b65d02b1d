"""Typed reading of text columns, with a side table of what could not be read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pipewatch.functions import scalars

# How a text becomes a value of each kind, and what is said of one that does not.
KINDS = {
    "timestamp": (scalars.to_utc_timestamp, "no timestamp"),
    "number": (scalars.to_number, "no number"),
}


def _missing(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def typed_rows(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """``df`` with the columns in ``kinds`` (name to "timestamp" or "number") converted; what cannot be read is NULL."""
    return df.withColumns({c: KINDS[kind][0](F.trim(F.col(c))) for c, kind in kinds.items()})


def rejected_rows(df: DataFrame, keys: Sequence[str], kinds: Mapping[str, str]) -> DataFrame:
    """Keys, ``column_name``, ``value``, ``reason``: each text that is there and cannot be read as its kind.

    One pass over the rows, however many columns there are. NULL and blank texts are missing, not rejected.
    """
    faults = []
    for c, kind in kinds.items():
        convert, reason = KINDS[kind]
        bad = ~_missing(F.col(c)) & convert(F.trim(F.col(c))).isNull()
        fault = F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"), F.lit(reason).alias("reason"))
        faults.append(F.when(bad, fault))
    return df.select(*keys, F.explode(F.array_compact(F.array(*faults))).alias("_fault")).select(*keys, "_fault.*")
