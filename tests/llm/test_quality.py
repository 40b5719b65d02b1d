"""Quality rules: statistics by brute force, constraints, held-out accuracy."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pipewatch.llm import boosting, quality

TEXTS = [
    None,
    "",
    " \n\t ",
    "a b c a b c a b d",
    "one line\none line\n\nÉté # * |\n one line\n \n",
    "x\x0by\x0cz\x85w v",
    "a a a a",
    "word " * 30_000,
    "a" * 200_000,
]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = {}
    for w in windows:
        counts[w] = counts.get(w, 0) + 1
    covered = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_statistics_equal_brute_force(spark):
    docs = spark.createDataFrame([*enumerate(TEXTS), (None, "a b")], "doc_id long, text string").withColumn("n_words", F.lit("clash"))
    got = {r.doc_id: tuple(r)[1:6] for r in quality.text_statistics(docs).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)} | {None: brute("a b")}
    assert quality.repeated_words(np.array([0, 1, 2, 0, 1, 2]), 3_000_000) == 6


def test_constraints_hold():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = (rng.random(3000) < 0.5 + 0.4 * np.sin(9 * x[:, 0]) * (x[:, 1] > 0.3)).astype(float)
    free, bound = (boosting.fit_forest(x, y, m, trees=30) for m in ([0, 0, 0], [-1, 0, 1]))
    grid = np.repeat(rng.random((50, 3)), 40, axis=0)
    grid[:, 0] = np.tile(np.linspace(0, 1, 40), 50)
    steps = np.diff(bound.probability(grid).reshape(50, 40), axis=1)
    assert (steps <= 1e-12).all() and steps.min() < -1e-3
    assert (np.diff(free.probability(grid).reshape(50, 40), axis=1) > 1e-3).any()
    grid = np.repeat(rng.random((50, 3)), 40, axis=0)
    grid[:, 2] = np.tile(np.linspace(0, 1, 40), 50)
    assert (np.diff(bound.probability(grid).reshape(50, 40), axis=1) >= -1e-12).all()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    apart = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    apart_labels = labels.where(apart).select("doc_id", F.col("quality").alias("good"))
    got = quality.quality_rules(docs, labels.where(~apart)).join(apart_labels, "doc_id").select("quality", "good").toPandas()
    good, bad = got[got.good == 1].quality, got[got.good == 0].quality
    assert len(bad) > 5 and (good >= 0.5).mean() > 0.9 and (bad < 0.5).mean() > 0.7


@pytest.mark.parametrize("labels", [[], [(0, 1), (1, 1)], [(None, 1), (0, None)]])
def test_without_usable_labels(spark, labels):
    docs = spark.createDataFrame([(0, "a b c " * 30), (1, " ".join(map(str, range(60)))), (2, None)], "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    assert {r.doc_id: r.kept for r in quality.quality_rules(docs, known).collect()} == {0: False, 1: True, 2: False}
    assert quality.quality_rules(docs.limit(0), known).count() == 0
