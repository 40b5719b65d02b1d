"""The pipeline against its parts by brute force on a small table."""

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline as cp
from test_neardup import shingle_set
from test_tokens import check_packing

from pipewatch.llm.exact_dedup import drop_exact_duplicates, exact_groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF).cache()
        out.append(docs.collect())
    return out


def test_stages(spark, stages):
    raw, clean, single, distinct, private, packed = stages
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = {r.doc_id for r in raw} - {r.doc_id for r in clean}
    assert gone and np.mean([labels[d] for d in gone if d in labels]) > 0.5
    assert {tuple(r) for r in clean} <= {tuple(r) for r in raw}
    last = {}
    for r in clean:
        low = "".join(c.lower() if c.isascii() else c for c in r.text)
        last[low] = max(last.get(low, r), r, key=lambda x: x.doc_id)
    assert sorted(map(tuple, single)) == sorted(map(tuple, last.values()))
    sets = {r.doc_id: shingle_set(r.text) for r in single}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) > 0]
    up = {d: d for d in sets}
    for _ in sets:
        for a, b in links:
            up[b] = up[a] = min(up[a], up[b])
    assert sorted(map(tuple, distinct)) == sorted(tuple(r) for r in single if up[r.doc_id] == r.doc_id)
    assert [r.doc_id for r in sorted(private)] == [r.doc_id for r in sorted(distinct)]
    assert all("@" not in r.text or ".example.com" not in r.text for r in private)
    assert all(r.n_chars == len(r.text) for r in private)
    assert {r.doc_id for r in packed} == {r.doc_id for r in private}
    check_packing(packed, 4096)


def test_run_equals_stages(spark, stages):
    key = lambda rows: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert key(cp.run(spark, SF).collect()) == key(stages[-1])


@pytest.mark.parametrize("stage", ["toxicity", "packing"])
def test_python_gets_few_rows_at_a_time(spark, tmp_path, stage):
    """What one stage's batches take of an executor's memory is still taken in the next stages."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.createDataFrame([(i, i % 7 // 6) for i in range(0, 3000, 2)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    def texts(batches):
        for batch in batches:
            assert len(batch) <= 1000, len(batch)
            ids = batch.column(0).to_pylist()
            said = [f"{'you scum idiot' if i % 7 == 6 else 'a fine day'} number{i} of many" for i in ids]
            yield pa.RecordBatch.from_pydict({"doc_id": ids, "text": said, "lang": ["en"] * len(ids), "source": ["s"] * len(ids), "n_chars": ids})

    docs = spark.range(0, 3000, 1, 1).mapInArrow(texts, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id for r in dict(cp.STAGES)[stage](spark, docs, str(tmp_path)).collect()}
    assert got == {i for i in range(3000) if stage != "toxicity" or i % 7 != 6}
    assert spark.conf.get(name) == before


def test_exact_dedup_edge_cases(spark):
    rows = [(1, "A é"), (2, "a é"), (3, "a É"), (None, None), (4, ""), (None, "x"), (None, "X"), (7, "dup"), (7, "dup"), (7, "DUP")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "doc_id AS _key", "'z' AS bucket")
    got = exact_groups(docs).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got if r.doc_id and r.doc_id != 7) == [
        (1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True), (4, 4, 2, True),
    ]
    assert sorted(r.kept for r in got if r.doc_id == 7) == [False, False, True]
    assert sorted((r.keep_id or 0, r.group_size, r.kept) for r in got if r.doc_id is None) == [(0, 2, False), (0, 2, True), (4, 2, False)]
    kept = drop_exact_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == 5
    assert exact_groups(docs.limit(0)).count() == 0 and drop_exact_duplicates(docs.limit(0)).count() == 0
