"""Ranked lexical search: equal to scoring every document, blocks skipped, odd rows defined."""

import math
import random
import re

import numpy as np
import pytest

from pipewatch.llm import lexical
from pipewatch.llm.lexical import Best, ranked_search, search_shard, shard_arrays, terms_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(FOLD))


def scores(docs, items, top=50):
    docs = [(k, words(t)) for k, t in docs]
    docs = [(k, w) for k, w in docs if w]
    total, length = len(docs), sum(len(w) for _, w in docs)
    df = {}
    for _, w in docs:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        found = []
        for k, w in docs:
            m = 50 + (50 * len(w) * total) // length
            s = 0
            for t in set(words(text)) & set(w):
                tf = w.count(t)
                s += math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * tf) // (1000 * tf + 20 * m))
            if s > 0:
                found.append((-s, k is None, k or 0, k))
        out += [(item, i + 1, k, -s) for i, (s, _, _, k) in enumerate(sorted(found)[:top])]
    return out


def corpus(n, seed=5):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    topics = [rnd.sample(vocabulary, 12) for _ in range(4)]
    rows = [(i, " ".join(rnd.choices(topics[i % 4] + vocabulary[:4], k=rnd.randrange(1, 40)))) for i in range(n)]
    items = [(i, " ".join(rnd.sample(vocabulary, 7))) for i in range(9)]
    return rows, items


def run(spark, docs, items, **named):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item", "2 AS score", "3 AS n", "4 AS body")
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS item", "2 AS rank")
    return sorted(map(tuple, ranked_search(d, i, **named).collect()), key=repr)


def test_equals_scoring_every_document(spark, monkeypatch):
    docs, items = corpus(700)
    docs += docs[:30]
    docs += [(None, "w1 w2 w3 w4"), (None, None), (9001, None), (9002, ""), (9003, "-- ;"), (9004, "É w1 ÉW1"), (9005, "w5 " * 40_000)]
    items += [(2, "w5 w6"), (None, "w1 éw1"), (77, None), (78, ""), (79, "nowhere"), (80, "W1 w1 É")]
    expected = sorted(scores(docs, items), key=repr)
    assert run(spark, docs, items) == expected
    # Several item blocks, small shards and blocks, fewer answers.
    for name, value in (("SHARD", 48), ("BLOCK", 4)):
        monkeypatch.setattr(lexical, name, value)
    assert run(spark, docs, items, max_terms=15) == expected
    assert run(spark, docs, items, top=3) == sorted(scores(docs, items, 3), key=repr)
    # One item beyond the limit of terms is a block of its own with smaller shards.
    monkeypatch.setattr(lexical, "MAX_TERMS", 2)
    assert run(spark, docs, items, max_terms=2) == expected


def test_empty_tables(spark):
    docs, items = corpus(20)
    assert run(spark, [], items) == run(spark, docs, []) == run(spark, [(1, None)], items) == []


def test_terms():
    text = "Él ÁB, don't x2 y z\x85q ÀÉ_É"
    assert [t.decode() for t in terms_of(text.encode())] == words(text)


def vectors(rnd, documents, size):
    rows = []
    for d in range(documents):
        # Documents of a topic hold its terms often, others seldom.
        own = [t for t in range(size) if t % 8 == d % 8]
        rows.append(sorted({*rnd.sample(own, 6), *rnd.sample(range(size), 2)}))
    return rows


def test_blocks_are_skipped_and_bounds_hold():
    rnd = random.Random(2)
    size, rows = 80, vectors(rnd, 4000, 80)
    terms = np.array([t for r in rows for t in r])
    offsets = np.cumsum([0, *map(len, rows)])
    tfs = np.array([rnd.randrange(1, 5) for _ in terms])
    ns = np.array([rnd.randrange(8, 200) for _ in rows])
    arrays = shard_arrays((np.arange(4000), np.ones(4000)), ns, offsets, terms, tfs, 4000, int(ns.sum()))
    exact = np.zeros((4000, size), np.int64)
    exact[np.repeat(np.arange(4000), np.diff(offsets)), terms] = arrays["vector_impacts"]
    for b in range(len(arrays["block_terms"])):
        docs = arrays["block_docs"][arrays["block_offsets"][b] : arrays["block_offsets"][b + 1]]
        at = slice(arrays["summary_offsets"][b], arrays["summary_offsets"][b + 1])
        assert 0 < len(docs) <= lexical.BLOCK and (exact[docs, arrays["block_terms"][b]] > 0).all()
        top = np.zeros(size, np.int64)
        top[arrays["summary_terms"][at]] = arrays["summary_impacts"][at].astype(int) * lexical.STEP
        assert (exact[docs].max(axis=0) <= top).all()
    weight = np.array([rnd.randrange(100, 3000) for _ in range(size)])
    items = [np.array(sorted(rnd.sample([t for t in range(size) if t % 8 == q % 8], 5), key=lambda t: -weight[t])) for q in range(8)]
    best = [Best(1, 50) for _ in items]
    scored = search_shard(arrays, size, items, weight, best)
    assert scored < 0.6 * 4000 * len(items)
    for terms, b in zip(items, best):
        all_scores = exact[:, terms] @ weight[terms]
        first = sorted(zip(-all_scores, range(4000)))[:50]
        assert [(-s, d) for s, d in zip(b.score, b.doc)] == [(int(s), d) for s, d in first]


@pytest.mark.parametrize("n", [0, 1, 64, 65, 500])
def test_blocks_hold_every_member(n):
    members = np.arange(0, 2 * n, 2)
    blocks = lexical.blocks_of(members, np.random.default_rng(1).standard_normal((2 * n + 1, 4)))
    assert sorted(np.concatenate(blocks)) == list(members)


def test_a_kept_index_answers_alike(spark):
    docs, items = corpus(300)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    vocabulary = sorted({t for _, text in items for t in terms_of(text.encode())})
    vectors = lexical.term_vectors(table, vocabulary).cache()
    numbered = [np.array([vocabulary.index(t) for t in terms_of(text.encode())]) for _, text in items]
    weight = np.arange(1, len(vocabulary) + 1) * 37
    length = vectors.agg({"n": "sum"}).first()[0]
    args = (len(vocabulary), numbered, weight, [1] * len(items), 20)
    index = lexical.build_index(vectors, len(vocabulary), 300, length)
    kept = lexical.best_of(lexical.search_index(index, *args), 20).collect()
    assert kept and sorted(kept) == sorted(lexical.best_of(lexical.search_vectors(vectors, len(vocabulary), 300, length, *args[1:]), 20).collect())
