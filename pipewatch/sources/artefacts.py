"""Readers of artefacts and object listings, sinks, dated predictions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A CSV with a header; strings unless a schema is given. Quoted line breaks are fine."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    return (reader.schema(schema) if schema else reader).csv(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): one row per file with its whole content."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )


def try_read_text(spark: SparkSession, path: str) -> DataFrame:
    """As :func:`read_text`; a missing path gives no row."""
    try:
        return read_text(spark, path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, text string")


def read_target(spark: SparkSession, root: str, target: str) -> DataFrame:
    """(target, text) of one artefact: a file, or a folder whose part files follow one another by name."""
    parts = try_read_text(spark, f"{root.rstrip('/')}/{target}").groupBy(F.lit(target).alias("target"))
    return parts.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", "text"))), lambda s: s["text"]), "").alias("text"))


def numbered_csv(rows: DataFrame, file: str = "_file", row_no: str = "_row_no") -> DataFrame:
    """Rows of :func:`read_csv` with two columns that give their order: the file, and the place within it."""
    return rows.select("*", F.col("_metadata.file_path").alias(file), F.monotonically_increasing_id().alias(row_no))


def read_source(spark: SparkSession, source_kind: str, target: str, render_kind: str) -> DataFrame:
    """An artefact by its kind: a table, a CSV file or a text file."""
    if source_kind == "table":
        return spark.read.table(target)
    if source_kind != "file":
        raise ValueError(f"unknown source kind: {source_kind!r}")
    if render_kind == "csv":
        return read_csv(spark, target)
    if render_kind in ("md", "json"):
        return read_text(spark, target)
    raise ValueError(f"unknown render kind: {render_kind!r}")


def list_objects(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, bytes, modified) of the files under ``root``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    )


# --- sinks ----------------------------------------------------------------


def write_dated(df: DataFrame, path: str, day: date, fmt: str = "parquet") -> None:
    """Replace one day's partition of a dated table, leave the others."""
    (
        df.withColumn("dt", F.lit(day))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy("dt")
        .format(fmt)
        .save(path)
    )


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.mode("overwrite").option("header", True).format(fmt).save(path)


def write_artefact(df: DataFrame, root: str, target: str, order: Sequence[Column | str], render_kind: str = "csv") -> None:
    """An artefact under the name that discovery looks for: a folder whose part files are in the order of ``order``.

    A CSV takes all columns but arrays, maps and structs; other kinds take the lines in ``value``.
    """
    path = f"{root.rstrip('/')}/{target}"
    # Sorted by ranges: no task holds more than its own.
    ordered = df.orderBy(*order)
    if render_kind == "csv":
        flat = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("array", "map", "struct")]
        ordered.select(*[F.col(f"`{c}`") for c in flat]).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    else:
        ordered.select("value").write.mode("overwrite").text(path)


def read_dated(spark: SparkSession, path: str, day: date, schema: StructType) -> DataFrame:
    """One day of a dated table; empty when there is none."""
    try:
        found = spark.read.parquet(path).where(F.col("dt") == F.lit(day))
    except AnalysisException as exc:
        if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)
    return found.drop("dt")


def read_with_previous_day(
    spark: SparkSession, path: str, day: date, schema: StructType
) -> tuple[DataFrame, DataFrame]:
    """Predictions of a day and of the day before."""
    return (
        read_dated(spark, path, day, schema),
        read_dated(spark, path, day - timedelta(days=1), schema),
    )
