"""Column helpers that several text operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pipewatch.session import shared_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def whole_text(column: str | Column) -> Column:
    """The text, with NULL as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; ``lower`` does just that where every character is ASCII, and is quicker."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def with_plain_names(docs: DataFrame, change: Callable[..., DataFrame], **named: str) -> DataFrame:
    """``change`` of ``docs`` under column names that no helper column has, then under their own names again.

    ``named`` are arguments of ``change`` that name columns; ``change`` keeps the columns and their order.
    """
    plain = [f"c{i}" for i in range(len(docs.columns))]
    place = dict(zip(docs.columns, plain))
    return change(docs.toDF(*plain), **{argument: place[name] for argument, name in named.items()}).toDF(*docs.columns)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: compact, columnar and safe when executors go."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; it goes with the folder of the session's checkpoints."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
