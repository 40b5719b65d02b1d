"""The corpus pipeline: from raw documents to packed token sequences.

``run`` applies the stages to ``documents``. Each stage is written as Parquet into the shared
folder and read again as the next one's input, so a lost executor costs a task, not a stage.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pipewatch.llm.common import read_table, written  # noqa: E402
from pipewatch.llm.exact_dedup import drop_exact_duplicates  # noqa: E402
from pipewatch.llm.neardup import drop_near_duplicates  # noqa: E402
from pipewatch.llm.packing import pack_documents  # noqa: E402
from pipewatch.llm.pii import sanitise  # noqa: E402
from pipewatch.llm.queries import vocabulary  # noqa: E402
from pipewatch.llm.toxicity import REJECT_FROM, fit_toxicity, held_out, toxicity  # noqa: E402
from pipewatch.session import small_batches  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Documents that a task hands Python at a time. What a stage takes, its JVM and its Python workers mostly
# keep, so the memory of a later stage is that of all before it, too.
BATCH_ROWS = 1000


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go; labels come from the training rows only."""
    labels = read_table(spark, sf_dir, "labels").where(~held_out())
    with small_batches(spark, BATCH_ROWS):
        model = fit_toxicity(docs, labels)
        # Written here, as the size of batches counts when a job runs.
        return written(docs.where(toxicity(F.col("text"), model) < REJECT_FROM).select(*COLUMNS), "not-toxic")


def copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return drop_exact_duplicates(docs).select(*COLUMNS)


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, similarity 0.8 or more) the smallest id stays."""
    return drop_near_duplicates(docs, percent=80).select(*COLUMNS)


def personal_data_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced, revealing terms are generalised or removed; no document goes."""
    return sanitise(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of 4096 tokens."""
    with small_batches(spark, BATCH_ROWS):
        return pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic_out),
    ("exact_dedup", copies_out),
    ("near_dedup", near_copies_out),
    ("pii", personal_data_out),
    ("packing", packed),
]

# A classifier that is fitted and a tokenizer cannot be stated in SQL; the tests hold the stages
# against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole of ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
