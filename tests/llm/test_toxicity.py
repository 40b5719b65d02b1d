"""Toxicity: held-out accuracy, the label model on drawn votes, missing labels and texts."""

import numpy as np
from pyspark.sql import functions as F

from pipewatch.llm import toxicity as tx


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = tx.fit_toxicity(docs, labels.where(~tx.held_out()))
    got = docs.where(tx.held_out()).join(labels, "doc_id").select("toxic", tx.toxicity(F.col("text"), model).alias("s")).toPandas()
    toxic, clean = got[got.toxic == 1].s, got[got.toxic == 0].s
    assert len(toxic) > 5 and (toxic >= 0.3).mean() > 0.6 and (clean >= 0.3).mean() < 0.02


def test_label_model_finds_rates_and_copies(spark):
    rng = np.random.default_rng(3)
    y = rng.random(6000) < 0.2
    rates = np.array([[0.002, 0.01, 0.005, 0.002, 0.02], [0.5, 0.3, 0.4, 0.5, 0.3]])
    votes = rng.random((6000, 5)) < rates[y.astype(int)]
    votes[:, 3] = votes[:, 0]  # one voter copies another
    # One row in ten is labelled.
    rows = [(np.flatnonzero(v).tolist(), int(t) if i % 10 == 0 else None, 1) for i, (v, t) in enumerate(zip(votes, y))]
    patterns = spark.createDataFrame(rows, "voters array<int>, label int, n long")
    model = tx.fit_label_model(patterns, 5)
    assert np.abs(model.rates[1, :3] - rates[1, :3]).max() < 0.1 and abs(model.prior - 0.2) < 0.05
    assert model.weights[0] < 0.6 and model.weights[3] < 0.6 and model.weights[1] > 0.9
    p = model.posterior([np.flatnonzero(v) for v in votes])
    assert ((p > 0.5) == y).mean() > 0.9


def test_without_labels_and_texts(spark):
    docs = spark.createDataFrame(
        [(1, "you stupid idiot, you moron"), (2, None), (3, ""), (None, "a fine day " * 10), (1, "you stupid idiot, you moron")],
        "doc_id long, text string",
    ).withColumn("label", F.lit("clash"))
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    for known in (labels, labels.union(spark.createDataFrame([(None, 1), (2, None)], labels.schema))):
        model = tx.fit_toxicity(docs, known)
        got = docs.select("doc_id", "text", tx.toxicity(F.col("text"), model).alias("s")).collect()
        assert len(got) == 5 and all((r.s >= 0.3) == bool(r.text and "idiot" in r.text) for r in got)
    model = tx.fit_toxicity(docs.limit(0), labels)
    assert docs.select(tx.toxicity(F.col("text"), model).alias("s")).where("s >= 0.3").count() == 2
    assert docs.limit(0).select(tx.toxicity(F.col("text"), model)).count() == 0


def dense_model(rows, size, known):
    """The label model from whole matrices of votes; ``known`` is the share of class 1 per row."""
    sums, totals, none = np.zeros((2, size, size)), np.zeros(2), np.zeros(2)
    for (v, _, n), q in zip(rows, known):
        for c, part in ((0, n * (1 - q)), (1, n * q)):
            totals[c] += part
            none[c] += part * (not v)
            for a in v:
                for b in v:
                    sums[c, a, b] += part
    fired = np.stack([np.diag(sums[c]) for c in (0, 1)])
    rates = np.clip((fired + 2 * np.array([[1e-4], [0.05]])) / (totals[:, None] + 2), 1e-6, 1 - 1e-6)
    rates[1] = np.maximum(rates[1], rates[0])
    shared = np.zeros(size)
    for a in range(size):
        for b in range(size):
            most = 0.0
            for c in (0, 1):
                if a != b and min(fired[c, a], fired[c, b]) >= 3:
                    m = fired[c] / totals[c]
                    s = np.sqrt(np.maximum(m * (1 - m), 1e-12))
                    most = max(most, (sums[c, a, b] / totals[c] - m[a] * m[b]) / (s[a] * s[b]))
            shared[a] += most if most > 0.5 else 0
    return rates, 1 / (1 + shared), (none + 2 * np.array([0.98, 0.2])) / (totals + 2)


def test_sums_equal_whole_matrices(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = []
    for _ in range(400):
        v = set(np.flatnonzero(rng.random(40) < 0.08).tolist())
        v |= {7} if 3 in v and rng.random() < 0.9 else set()
        rows.append((sorted(v), [None, 0, 1][rng.integers(3)], int(rng.integers(1, 5))))
    patterns = spark.createDataFrame(rows, "voters array<int>, label int, n long").repartition(3)
    monkeypatch.setattr(tx, "PAIRS_HELD", 50)
    labelled = [r for r in rows if r[1] is not None]
    first = tx.estimate(*tx.class_sums(patterns, None, 40), 40)
    for model, used, known in (
        (first, labelled, [r[1] for r in labelled]),
        (tx.estimate(*tx.class_sums(patterns, first, 40), 40), rows,
         [p if r[1] is None else r[1] for r, p in zip(rows, first.posterior([np.array(r[0], int) for r in rows]))]),
    ):
        rates, weights, silent = dense_model(used, 40, known)
        assert np.allclose(model.rates, rates) and np.allclose(model.weights, weights) and np.allclose(model.silent, silent)
    assert first.weights[3] < 1 and first.weights[7] < 1


def test_few_terms_are_held(spark, monkeypatch):
    """A worker keeps what it once took, so a task hands on its counts before they are many; the sums are the same."""
    rows = [(f"word{i % 13} word{i % 7} other{i}", int(i % 5 == 0)) for i in range(200)]
    labelled = spark.createDataFrame(rows, "text string, label int").coalesce(1)
    assert tx.TERMS_HELD <= 50_000
    whole = sorted(map(tuple, tx.term_counts(labelled).collect()))
    monkeypatch.setattr(tx, "TERMS_HELD", 40)
    assert sorted(map(tuple, tx.term_counts(labelled).collect())) == whole
    words = {}
    for text, label in rows:
        for t in {t for w in tx._WORD.findall(text) for t in tx.terms_of(w)}:
            words.setdefault(t, [0, 0])[0 if label else 1] += 1
    assert [(t, a, b) for t, a, b, _ in whole] == sorted((t, *n) for t, n in words.items())


def test_more_voters_than_a_fixed_number(spark):
    """Every term that marks toxic documents votes, however many there are."""
    letters = "abcdefghij"
    words = ["q" + letters[i // 100] + letters[i // 10 % 10] + letters[i % 10] for i in range(400)]
    rows = [(i * 30 + j, f"{w} note{i}x{j}", 1) for i, w in enumerate(words) for j in range(30)]
    rows += [(10**6 + i, f"fine day of number{i}", 0) for i in range(108_000)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, label int").select("text", "label")
    lexicon = tx.learn_lexicon(labelled)
    assert set(words) <= set(lexicon) and len(lexicon) == len(set(lexicon))
