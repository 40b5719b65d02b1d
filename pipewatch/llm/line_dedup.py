"""Line deduplication with levelled sorted runs of line hashes.

A line's key is the line with ASCII white space stripped at both ends and A-Z lower-cased. Keys are known by
128-bit hashes. Documents come in batches. A batch's keys, summed to one row each, are merge-anti-joined with
the runs of all earlier batches: what is new becomes a run of its own, what was seen before goes to a second
family of runs that only holds repetitions. A run is a table bucketed by hash and sorted within its buckets, so
these joins shuffle nothing. ``FANOUT`` runs of a level are compacted into one run of the next level, so a key is
looked up in few runs, however many batches there were. At the end both families are summed: keys of at least
``at_least`` documents with the largest id that holds each.

Applying it, no line's occurrences meet in one task: a line with more than 1 / ``HOT`` of all occurrences is
one of at most ``HOT`` lines, which are broadcast; the others are joined by hash. Only documents that may lose
a line (a Bloom filter over their ids) are shuffled with their texts, the rest pass straight through.

Defined results: a NULL or empty text is one empty line and loses nothing; whole texts are split, however long; a
line repeated within a document counts once for it, and all its occurrences share its fate; each row is a document,
and rows that share the largest id that holds a key all keep it; a NULL id is smaller than any other; an empty
table gives an empty one. Only key and text are read, so other columns of any name do not matter.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pipewatch.llm.bloom import bit_table, filter_bits, with_hits
from pipewatch.llm.common import scratch_path, written
from pipewatch.session import durable

MIN_POINTS = 20
AT_LEAST = 3
BATCHES = 4
FANOUT = 2
HOT = 4096
WHITE = b" \t\n\x0b\x0c\r"
KEY = ["hi", "lo"]
RUN = "hi long, lo long, n long, top long"


def line_key(line: bytes, min_points: int) -> bytes | None:
    """The key of a line in UTF-8, None where it has fewer code points."""
    key = line.strip(WHITE)
    if len(key) < min_points or not key.isascii() and len(key.decode()) < min_points:
        return None
    # Lower-cases A-Z only, as it works on bytes.
    return key.lower()


def _hash(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def line_hashes(docs: DataFrame, key: str = "doc_id", text: str = "text", min_points: int = MIN_POINTS) -> DataFrame:
    """``id``, ``hi``, ``lo``: one row per document and different key of its lines."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found = [], []
            for body in batch.column(1):
                lines = (body.as_py() or b"").split(b"\n")
                own = {_hash(k) for k in (line_key(line, min_points) for line in lines) if k is not None}
                counts.append(len(own))
                found.extend(sorted(own))
            ids = batch.column(0).take(pa.array([i for i, n in enumerate(counts) for _ in range(n)], pa.int64()))
            halves = pa.Array.from_buffers(pa.int64(), 2 * len(found), [None, pa.py_buffer(b"".join(found))]).to_numpy()
            yield pa.RecordBatch.from_arrays([ids, pa.array(halves[::2]), pa.array(halves[1::2])], names=["id", *KEY])

    narrow = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("binary").alias("body"))
    return narrow.mapInArrow(hashes, "id long, hi long, lo long")


class LineRuns:
    """Levelled sorted runs of the line keys seen so far.

    ``first`` holds each key once, with the counts of the batch that brought it; ``again`` holds the
    counts of later batches. Both are lists of levels, each a list of table names.
    """

    def __init__(self, spark: SparkSession, buckets: int | None = None, fanout: int = FANOUT):
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.fanout = fanout
        self.paths: dict[str, str] = {}
        self.first: list[list[str]] = []
        self.again: list[list[str]] = []

    def add(self, batch: DataFrame) -> None:
        """Takes in a batch of ``line_hashes``."""
        # Summed on the map side too: a line of every document is one row per task.
        keys = self._run(batch.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top")))
        earlier = [name for level in self.first for name in level]
        if not earlier:
            self._push(self.first, keys)
            return
        unseen = self.spark.table(keys)
        for name in earlier:
            unseen = unseen.join(self.spark.table(name).select(*KEY).hint("merge"), KEY, "left_anti")
        new = self._run(unseen)
        seen = self._run(self.spark.table(keys).join(self.spark.table(new).select(*KEY).hint("merge"), KEY, "left_anti"))
        self.spark.sql(f"DROP TABLE {keys}")
        self._push(self.first, new)
        self._push(self.again, seen)

    def _run(self, keys: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.paths[name] = scratch_path(self.spark, name)
        (
            keys.repartition(self.buckets, *KEY)
            .write.bucketBy(self.buckets, *KEY)
            .sortBy(*KEY)
            .option("path", self.paths[name])
            .saveAsTable(name)
        )
        return name

    def _push(self, levels: list[list[str]], name: str) -> None:
        level = 0
        while True:
            if level == len(levels):
                levels.append([])
            levels[level].append(name)
            if len(levels[level]) < self.fanout:
                return
            full, levels[level] = levels[level], []
            name = self._run(self._summed(full))
            for old in full:
                self.spark.sql(f"DROP TABLE {old}")
            level += 1

    def _summed(self, names: list[str]) -> DataFrame:
        # One scan of plain files: a union of bucketed scans would claim a partitioning it does not keep.
        runs = self.spark.read.schema(RUN).parquet(*[self.paths[n] for n in names])
        return runs.groupBy(*KEY).agg(F.sum("n").alias("n"), F.max("top").alias("top"))

    def repeated(self, at_least: int = AT_LEAST) -> DataFrame:
        """``hi``, ``lo``, ``n``, ``top``: the keys that so many documents hold, and the largest id that does."""
        names = [name for levels in (self.first, self.again) for level in levels for name in level]
        return self._summed(names).where(F.col("n") >= at_least)

    def forget(self) -> None:
        """Removes the runs from the catalog."""
        for name in (name for levels in (self.first, self.again) for level in levels for name in level):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _loses() -> Column:
    """A document with a smaller id than the largest that holds the key loses it; NULL is the smallest."""
    return F.coalesce(F.col("id") < F.col("top"), F.col("top").isNotNull())


def lost_lines(hashes: DataFrame, repeated: DataFrame) -> DataFrame:
    """``id`` and the keys it loses, as a list of (``hi``, ``lo``)."""
    # At most HOT keys have so many occurrences.
    many = hashes.count() / HOT
    hot = F.broadcast(repeated.where(F.col("n") > many).select(*KEY, "top"))
    lost_hot = hashes.join(hot, KEY).where(_loses())
    cold = hashes.join(hot.select(*KEY), KEY, "left_anti").join(repeated.where(F.col("n") <= many).select(*KEY, "top"), KEY)
    lost = lost_hot.select("id", *KEY).unionByName(cold.where(_loses()).select("id", *KEY))
    return lost.groupBy("id").agg(F.collect_set(F.struct(*KEY)).alias("lost"))


def without_lines(texts: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """``id``, ``n_lines``, ``n_dropped``, ``kept`` from ``id``, ``body`` (binary) and ``lost`` (NULL: nothing)."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, dropped, kept = [], [], []
            for body, lost in zip(batch.column("body"), batch.column("lost")):
                text = body.as_py() or b""
                lines = text.split(b"\n")
                total.append(len(lines))
                if not lost.is_valid:
                    dropped.append(0)
                    kept.append(text)
                    continue
                gone = {k["hi"].to_bytes(8, "little", signed=True) + k["lo"].to_bytes(8, "little", signed=True) for k in lost.as_py()}
                stay = [line for line in lines if (k := line_key(line, min_points)) is None or _hash(k) not in gone]
                dropped.append(len(lines) - len(stay))
                kept.append(b"\n".join(stay))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(total, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary())],
                names=["id", "n_lines", "n_dropped", "kept"],
            )

    return texts.mapInArrow(rewrite, "id long, n_lines long, n_dropped long, kept binary").withColumn("kept", F.col("kept").cast("string"))


def drop_repeated_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    at_least: int = AT_LEAST,
    min_points: int = MIN_POINTS,
    batches: int = BATCHES,
) -> DataFrame:
    """Per document: key, ``n_lines`` (before dropping), ``n_dropped``, ``kept`` (its other lines)."""
    spark = docs.sparkSession
    hashed = line_hashes(docs, key, text, min_points).withColumn("batch", F.pmod(F.xxhash64("id"), F.lit(batches)))
    path = scratch_path(spark, "lines")
    hashed.write.partitionBy("batch").parquet(path)
    hashes = spark.read.schema("id long, hi long, lo long, batch long").parquet(path)
    runs = LineRuns(spark)
    try:
        for number in range(batches):
            runs.add(hashes.where(F.col("batch") == number).select("id", *KEY))
        repeated = durable(runs.repeated(at_least))
    finally:
        runs.forget()
    lost = written(lost_lines(hashes.select("id", *KEY), repeated), "lost-lines")

    narrow = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("binary").alias("body"))
    bits = filter_bits(lost.count())
    tested = with_hits(narrow, bit_table(lost.select(F.xxhash64("id")), bits), bits, F.xxhash64("id"), "maybe")
    untouched = tested.where(~F.col("maybe")).select("id", "body", F.lit(None).cast(lost.schema["lost"].dataType).alias("lost"))
    other = lost.withColumnRenamed("id", "of")
    touched = tested.where("maybe").join(other, F.col("id").eqNullSafe(F.col("of")), "left").select("id", "body", "lost")
    return without_lines(untouched.unionByName(touched), min_points).withColumnRenamed("id", key)
