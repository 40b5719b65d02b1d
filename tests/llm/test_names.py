"""Columns of the user's that are named like a helper's come back unchanged, and stages take odd rows."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pipewatch.llm.bloom import bit_table, filter_bits, with_hits
from pipewatch.llm.exact_dedup import drop_exact_duplicates
from pipewatch.llm.neardup import drop_near_duplicates
from pipewatch.llm.pii import sanitise

HELPERS = [
    "_row", "_spans", "_words", "_added", "_new", "_hits", "_probes", "_maybe", "_bucket0", "_bitmap1", "_digest", "_stay",
    "_id", "_gone", "_hit", "text_hash", "set_id", "node", "n", "kept", "component_id", "a `quoted` name", "c0", "c1",
]
LONG = " ".join(f"word{i}" for i in range(60))


def table(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("*", *[F.concat(F.lit(f"{i}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for i, c in enumerate(HELPERS)])


ROWS = [
    (1, "mail a.person@example.com now"), (2, "mail a.person@example.com now"), (3, LONG), (4, LONG + " more"),
    (5, None), (6, ""), (None, "alone"), (7, "x " * 30_000),
]


@pytest.mark.parametrize("change", [sanitise, drop_exact_duplicates, drop_near_duplicates])
def test_clashing_names(spark, change):
    docs = table(spark, ROWS)
    out = change(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    for r in rows:
        shown = "none" if r.doc_id is None else str(r.doc_id)
        assert [r[c] for c in HELPERS] == [f"{i}-{shown}" for i in range(len(HELPERS))]
    ids = {r.doc_id for r in rows}
    if change is sanitise:
        assert ids == {k for k, _ in ROWS} and "example.com" not in rows[0].text
    elif change is drop_exact_duplicates:
        # Of equal texts the largest id stays; NULL and empty texts are equal.
        assert ids == {2, 3, 4, 6, None, 7}
    else:
        # Equal and near ones go to the smallest id; texts without words link with nothing.
        assert ids == {1, 3, 5, 6, None, 7}
    assert change(docs.limit(0)).count() == 0


def test_hits_of_clashing_names(spark):
    docs = table(spark, ROWS)
    bits = filter_bits(8)
    hit = with_hits(docs, bit_table(docs.where("doc_id = 3").select(F.xxhash64("doc_id")), bits), bits, F.xxhash64("doc_id"), "found")
    assert hit.columns == [*docs.columns, "found"]
    got = {r.doc_id: r for r in hit.collect()}
    assert got[3].found and got[3]["_probes"].endswith("-3") and len(got) == len(ROWS)


@pytest.mark.parametrize("stage", ["exact_dedup", "near_dedup", "pii"])
def test_stages_take_odd_rows(spark, stage):
    fn = dict(corpus_pipeline.STAGES)[stage]
    docs = spark.createDataFrame([(k, t, None, "s", None) for k, t in ROWS], "doc_id long, text string, lang string, source string, n_chars long")
    out = fn(spark, docs, "")
    assert out.columns == docs.columns and out.count() >= 6
    assert fn(spark, docs.limit(0), "").count() == 0
