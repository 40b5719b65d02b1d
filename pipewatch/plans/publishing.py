"""A whole publish run: pages, attachments and state of what the plan says, as tables under one root.

Each run writes its own partition (``run=<id>``) of every table and, when all are written, a row of
``completed``. Readers take completed runs only, so a run that failed half-way leaves nothing behind
that counts, and is repeated under the same id or another.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from pipewatch.operators.ranking import latest_version, with_group_index
from pipewatch.plans import jobs, publish
from pipewatch.session import durable
from pipewatch.settings import PublishSettings
from pipewatch.sources import artefacts

TABLES = {
    "pages": "target string, title string, parent_title string, page_id string, page_no bigint, body string",
    "payload": "target string, row_no bigint, line string",
    "attachments": "target string, page_id string, attachment_filename string, attachment_content_type string, content_hash string",
    "state": "state_key string, page_id string, content_hash string, target string, published_at string",
    "outcomes": "target string, title string, action string",
    "completed": "finished_at string",
}
# Characters of a text that are one row of its payload.
PIECE = 1 << 16


def read_runs(spark: SparkSession, store: str, name: str) -> DataFrame:
    """Rows of a table of completed runs, with ``run`` and ``finished_at``."""

    def load(table: str) -> DataFrame:
        schema = f"{TABLES[table]}, run string"
        try:
            return spark.read.schema(schema).parquet(f"{store}/{table}")
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    done = load("completed")
    return done if name == "completed" else load(name).join(done, "run")


def newest_state(spark: SparkSession, store: str) -> DataFrame:
    """Per state key the row of the last completed run that published it."""
    rows = read_runs(spark, store, "state")
    return latest_version(rows, ["state_key"], [F.desc("finished_at"), F.desc("run")]).select(*publish.STATE_COLUMNS)


def current_pages(spark: SparkSession, store: str) -> DataFrame:
    """All parts of each target's page as its last completed run wrote them."""
    rows = read_runs(spark, store, "pages")
    last = rows.groupBy("target").agg(F.max(F.struct("finished_at", "run")).alias("_last"))
    mine = rows.join(last, "target").where((F.col("finished_at") == F.col("_last.finished_at")) & (F.col("run") == F.col("_last.run")))
    return mine.drop("_last")


def _csv_parts(
    spark: SparkSession, root: str, r, kept: tuple, generated_at: str, cfg: PublishSettings
) -> tuple[DataFrame, DataFrame]:
    """Page parts and payload lines of one CSV after its kind's filter."""
    rows = artefacts.read_csv(spark, f"{root}/{r['target']}")
    columns = rows.columns
    named = publish.kept_rows(artefacts.numbered_csv(rows, "_file", "_place"), *kept)
    named = named.select("*", F.lit(r["target"]).alias("_target"), F.lit(r["title"]).alias("_title"))
    placed = with_group_index(named, ["_target"], ["_file", "_place"], "_row_no")
    parts = publish.table_parts(placed, columns, root, generated_at, cfg, "_target", "_title", "_row_no")
    parts = parts.select(F.col("_target").alias("target"), F.col("page_no").cast("bigint").alias("page_no"), "body")
    if not placed.take(1):
        empty = F.concat(publish.heading(F.lit(r["title"])), F.lit("<p>Rows: 0</p>"), publish.footer(F.lit(f"{root}/{r['target']}"), F.lit(generated_at)))
        body = publish.with_marker(empty, cfg.auto_marker)
        parts = spark.range(1).select(F.lit(r["target"]).alias("target"), F.lit(1).cast("bigint").alias("page_no"), body.alias("body"))
    header = spark.createDataFrame([(r["target"], 0, ",".join(columns))], TABLES["payload"])
    lines = placed.select(F.col("_target").alias("target"), (F.col("_row_no") + 1).alias("row_no"), publish.csv_line(columns).alias("line"))
    return parts, header.unionByName(lines)


def _text_parts(spark: SparkSession, root: str, r, generated_at: str, cfg: PublishSettings) -> tuple[DataFrame, DataFrame]:
    """Page parts and payload pieces of one text; JSON is shown as a table of its values."""
    texts = artefacts.read_target(spark, root, r["target"]).withColumn("title", F.lit(r["title"]))
    columns = ["target", F.col("page_no").cast("bigint").alias("page_no"), "body"]
    last = F.greatest(F.expr("0"), F.floor((F.length("text") - 1) / PIECE)).cast("int")
    pieces = texts.select("target", "text", F.explode(F.sequence(F.lit(0), last)).alias("at")).select(
        "target", F.col("at").cast("bigint").alias("row_no"), F.substring(F.col("text"), F.col("at") * PIECE + 1, F.lit(PIECE)).alias("line")
    )
    if r["render_kind"] != "json":
        return publish.text_parts(texts, root, generated_at, cfg).select(*columns), pieces
    values = durable(publish.json_rows(texts, "target", "text").withColumn("title", F.lit(r["title"])))
    shown = publish.table_parts(values, ["path", "value"], root, generated_at, cfg, row_no="path").select(*columns)
    # What is no JSON, or has no value, is shown as it stands.
    plain = publish.text_parts(texts.join(values, "target", "left_anti"), root, generated_at, cfg).select(*columns)
    return shown.unionByName(plain), pieces


def publish_run(
    spark: SparkSession,
    root: str,
    store: str,
    run_id: str,
    run_day: date,
    now: datetime,
    cfg: PublishSettings = PublishSettings(),
    kinds: Sequence[tuple] = publish.KINDS,
) -> DataFrame:
    """Plan over the artefacts under ``root``, write what is to be published under ``store``; the plan.

    A page keeps its id when its artefact is published again. A run that is completed is not repeated.
    """
    root = root.rstrip("/")
    if read_runs(spark, store, "completed").where(F.col("run") == run_id).head(1):
        raise ValueError(f"run {run_id!r} is completed")
    stamp = now.isoformat(sep=" ", timespec="microseconds")
    state = durable(newest_state(spark, store))
    titles = read_runs(spark, store, "pages").select("title").distinct()
    plan = durable(jobs.publish_job(spark, root, titles, state, run_day, cfg, kinds))
    plan = plan.withColumn("page_id", F.coalesce("page_id", F.substring(F.sha2("title", 256), 1, 16)))
    todo = plan.where("action = 'publish'")

    parts = spark.createDataFrame([], "target string, page_no bigint, body string")
    payload = spark.createDataFrame([], TABLES["payload"])
    filters = {kind[0]: kind[5:7] for kind in kinds}
    # At most one artefact per kind and day of the lookback.
    for r in todo.select("target", "title", "render_kind", "path_template").collect():
        if r["render_kind"] == "csv":
            own, lines = _csv_parts(spark, root, r, filters[r["path_template"]], stamp, cfg)
        else:
            own, lines = _text_parts(spark, root, r, stamp, cfg)
        parts, payload = parts.unionByName(own), payload.unionByName(lines)
    pages = parts.join(todo.select("target", "title", "parent_title", "page_id"), "target")
    outputs = {
        "pages": pages,
        "payload": payload,
        "attachments": publish.with_attachment(todo),
        "state": todo.withColumn("published_at", F.lit(stamp)),
        "outcomes": plan,
        "completed": spark.createDataFrame([(stamp,)], TABLES["completed"]).coalesce(1),
    }
    for name, df in outputs.items():  # the last one makes the run count
        wanted = [c.split()[0] for c in TABLES[name].split(", ")]
        df.select(*wanted).write.mode("overwrite").parquet(f"{store}/{name}/run={run_id}")
    return plan
