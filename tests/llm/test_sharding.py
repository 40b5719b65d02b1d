"""Sharding: weights, gapless slots, and growth that moves records only into the new shard."""

import zlib

from pyspark.sql import functions as F

from pipewatch.llm.sharding import rendezvous, shard_records, write_shards


def test_slots_and_growth(spark):
    rows = [(i, "té" * (i % 7)) for i in range(3000)] + [(None, None), (None, None), (5, "té"), (5, "té")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS shard", "2 AS cell", "3 AS size")
    got = shard_records(docs, [1.0] * 16).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 16)
    assert sorted(by) == list(range(16)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert 100 < sum(r.grown_shard == 16 for r in got) < 260
    texts = {(k, t) for k, t in rows}
    assert {(r.doc_id, r.size, r.text_crc32) for r in got} == {(k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in texts}
    assert len({r.shard for r in got if r.doc_id == 5}) == 1
    assert shard_records(docs.limit(0), [1.0]).count() == 0


def test_weights(spark, tmp_path):
    ids = spark.range(20_000)
    counts = {r[0]: r[1] for r in ids.groupBy(rendezvous(F.col("id"), [1.0, 3.0]).alias("s")).count().collect()}
    assert abs(counts[1] / 20_000 - 0.75) < 0.02
    write_shards(ids.limit(100), str(tmp_path / "s"), [1.0, 1.0], key="id")
    assert spark.read.parquet(str(tmp_path / "s")).count() == 100
