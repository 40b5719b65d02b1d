"""Near duplicates: components equal those of all exact pairs; pruning keeps what it promises."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pipewatch.llm import components, neardup


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or frozenset([tuple(words)])


def brute(rows, percent):
    sets = [shingle_set(t) for _, t in rows]
    having = {}
    for i, s in enumerate(sets):
        for x in s:
            having.setdefault(x, []).append(i)
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, s in enumerate(sets):
        both = {}
        for x in s:
            for j in having[x]:
                if j < i:
                    both[j] = both.get(j, 0) + 1
        for j, n in both.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    groups = {}
    for i, (key, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(key)
    least = {r: min((k for k in own if k is not None), default=None) for r, own in groups.items()}
    return sorted(((k, len(sets[i]), least[root(i)]) for i, (k, _) in enumerate(rows)), key=repr)


def result(df):
    rows = df.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=repr)


@pytest.mark.parametrize("percent", [85, 80])
def test_equals_all_pairs(spark, percent):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert result(neardup.near_duplicates(docs, percent)) == brute(rows, percent)


@pytest.mark.parametrize("block", [32, 2048])
def test_cloud_around_the_threshold(spark, monkeypatch, block):
    """A large group of near copies, many of whose pairs are just above or below the threshold."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "SET_BLOCK", block)
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(250):
        words = list(base)
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
        rows.append((1000 + i, " ".join(words)))
    rows += [(i, " ".join(f"x{rng.randrange(10**6)}" for _ in range(60))) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(neardup.near_duplicates(docs, 85)) == brute(rows, 85)


def test_edge_cases(spark):
    rows = [
        (1, None), (2, ""), (3, " \n "), (4, "one two"), (5, "ONE\ttwo"), (6, "one twö"), (None, "one two"),
        (None, None), (7, "É a b c d e"), (8, "é a b c d e"), (9, "same " * 50), (9, "same " * 50), (10, "same " * 5),
        (11, " ".join(map(str, range(60_000)))), (12, " ".join(map(str, range(60_001)))), (None, "lonely text here"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit(1)).withColumn("set_id", F.lit(1))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs, 85).collect()), key=repr)
    want = brute([r for r in rows if shingle_set(r[1])], 85) + [(k, 0, k) for k, t in rows if not shingle_set(t)]
    assert got == sorted(want, key=repr)
    assert neardup.near_duplicates(docs.limit(0), 85).count() == 0
    kept = neardup.drop_near_duplicates(docs, 85)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 6, 7, 8, 9, 9, 11]


def test_pruning_misses_at_most_what_it_says():
    least = neardup.least_matches(85)
    rng = np.random.default_rng(2)
    same = rng.random((200_000, neardup.SIZE)) < 0.85
    pruned = np.zeros(len(same), bool)
    for n, m in least.items():
        pruned |= same[:, :n].sum(axis=1) < m
    assert pruned.mean() < len(least) * neardup.MISS * 1.5
    assert least[neardup.SIZE] > 0.7 * neardup.SIZE


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(8)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200), (300, 301), (301, 300)]
    hashed = spark.createDataFrame(edges, "a long, b long").select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b"))
    names = {r[1]: r[0] for r in spark.range(400).select("id", F.xxhash64("id")).collect()}
    groups = {}
    for r in components.connected(hashed).collect():
        groups.setdefault(r.root, set()).add(names[r.node])
    assert sorted(map(sorted, groups.values())) == [list(range(9)), list(range(100, 130)), [300, 301]]


def test_remembered_words_are_few():
    own = neardup.Shingler()
    texts = [" ".join(f"w{i}" for i in range(k, k + 5000)).encode() for k in range(0, 150_000, 5000)]
    first = [own.shingles(t) for t in texts]
    # Six workers share an executor with what other steps left behind.
    assert len(own.known) < 100_000
    assert all(np.array_equal(a, own.shingles(t)) for a, t in zip(first, texts))


def test_python_gets_few_rows_at_a_time(spark):
    """A batch of long texts is held several times over, so it must not have as many rows as there are."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)

    def texts(batches):
        for batch in batches:
            assert len(batch) <= 1000, len(batch)
            ids = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_pydict({"doc_id": ids, "text": [" ".join(f"w{i // 2}.{j}" for j in range(9)) for i in ids]})

    docs = spark.range(0, 4000, 1, 1).mapInArrow(texts, "doc_id long, text string")
    got = result(neardup.near_duplicates(docs, 85))
    assert sorted(got) == [(i, 5, i - i % 2) for i in range(4000)]
    assert spark.conf.get(name) == before


def test_forest_of_few_held_pairs_is_the_same(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**32, neardup.SIZE, dtype=np.uint32)
    rows = []
    for i in range(120):
        mark = np.where(rng.random(neardup.SIZE) < 0.12, rng.integers(0, 2**32, neardup.SIZE, dtype=np.uint32), base)
        mark[: neardup.ROWS] = base[: neardup.ROWS]
        rows.append((7, 0, 0, 0, 0, i, i // 2, mark.tobytes()))
    groups = spark.createDataFrame(rows, "bucket long, one int, two int, block int, band int, node long, root long, signature binary").coalesce(1)
    whole = sorted(map(tuple, neardup.candidate_pairs(groups, 80).collect()))
    ends = sorted(map(tuple, neardup.candidate_pairs(groups, 80, ends=True).collect()))
    monkeypatch.setattr(neardup, "PAIRS", 50)
    monkeypatch.setattr(neardup, "PAIRS_HELD", 40)
    assert len(whole) == 59
    assert sorted(map(tuple, neardup.candidate_pairs(groups, 80).collect())) == whole
    assert sorted(map(tuple, neardup.candidate_pairs(groups, 80, ends=True).collect())) == ends
