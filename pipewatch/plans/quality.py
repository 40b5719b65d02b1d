"""Data-quality tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType


def _missing(df: DataFrame, c: str):
    col = F.col(c)
    if isinstance(df.schema[c].dataType, (DoubleType, FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def duplicate_summary(df: DataFrame, keys: Sequence[str] = ("dag_id", "run_id")) -> DataFrame:
    """One row: all rows, and the rows whose key occurs more than once."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("duplicate_keys"),
    )


def null_rates(df: DataFrame, top: int | None = None) -> DataFrame:
    """(column_name, null_rate), emptiest first; one pass over the data."""
    one = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.when(_missing(df, c), 1)).alias(f"_m_{i}") for i, c in enumerate(df.columns)],
    )
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                (F.col(f"_m_{i}") / F.col("_rows")).alias("null_rate"),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    out = one.where("_rows > 0").select(F.inline(pairs)).orderBy(F.desc("null_rate"), "column_name")
    return out if top is None else out.limit(top)


def value_histogram(df: DataFrame, column: str) -> DataFrame:
    """(value, count), NULL included."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per numeric column: missing values, minimum, maximum, mean; one pass."""
    cols = list(columns) if columns else [
        f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)
    ]
    aggs = []
    for i, c in enumerate(cols):
        v = F.when(~_missing(df, c), F.col(c).cast("double"))
        aggs += [
            F.count(F.when(_missing(df, c), 1)).alias(f"_m{i}"),
            F.min(v).alias(f"_lo{i}"),
            F.max(v).alias(f"_hi{i}"),
            F.avg(v).alias(f"_avg{i}"),
        ]
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *aggs)
    return one.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"),
                        F.col("_rows").alias("row_count"),
                        F.col(f"_m{i}").alias("missing"),
                        F.col(f"_lo{i}").alias("min_value"),
                        F.col(f"_hi{i}").alias("max_value"),
                        F.col(f"_avg{i}").alias("mean_value"),
                    )
                    for i, c in enumerate(cols)
                ]
            )
        )
    )
