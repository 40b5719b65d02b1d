"""The prefix trie: equal to counting every prefix, parentheses by brute force, shards merged."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from pipewatch.llm import prefix_trie as pt
from pipewatch.llm.prefix_trie import excess_of, find_close, least_between, paths, prefix_trie, rebuilt

SCHEMA = "conv_id long, turn long, role string, text string"


def listed(rows):
    out = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}:{text}".encode()).hexdigest()
            out.setdefault(c, []).append((turn is not None, turn or 0, role, key, text))
    return {c: [(role, text) for *_, role, _, text in sorted(turns)] for c, turns in out.items()}


def chained(turns):
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = turns.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute(turns):
    nodes = {}
    for c, path in turns.items():
        for d in range(len(path) + 1):
            nodes.setdefault(tuple(path[:d]), []).append(c)
    children, leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for p in nodes:
        if p:
            children[p[:-1]] += 1
    for p, members in nodes.items():
        size = len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(members) - 1) * size
    return sorted(
        (
            (
                min(m),
                len(p),
                min(nodes[p[:-1]]) if p else None,
                len(m),
                children[p],
                leaves[p],
                saved[p],
                hashlib.sha256(",".join(map(str, sorted(c for c in m if len(turns[c]) == len(p)))).encode()).hexdigest(),
            )
            for p, m in nodes.items()
        ),
        key=repr,
    )


def conversations(n, seed=3):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rnd.randrange(1, 7)):
            rows.append((c, turn, rnd.choice(["user", "assistant"]), rnd.choice(["a", "bé", "ccc"])))
    return rows


def run(spark, rows, shards, rebuild=True):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS path", "2 AS shard", "3 AS least", "4 AS base")
    turns = paths(df)
    return sorted(map(tuple, prefix_trie(rebuilt(turns) if rebuild else turns, shards).collect()), key=repr)


@pytest.mark.parametrize(("shards", "fan_in"), [(1, 32), (7, 32), (9, 2)])
def test_equals_counting_every_prefix(spark, monkeypatch, shards, fan_in):
    monkeypatch.setattr(pt, "FAN_IN", fan_in)
    monkeypatch.setattr(pt, "PIECE", 40)
    rows = conversations(260)
    # Odd rows: no id, ties, repeated rows, NULLs, one long conversation, many copies.
    rows += [(None, 0, "user", "x"), (400, None, None, None), (400, 0, "user", "late"), (401, 0, "b", "q"), (401, 0, "a", "q"), (401, 0, "a", "p")]
    rows += [(402, 0, "user", "twice")] * 2 + [(403, i, "user", "ccc" * 900) for i in range(300)]
    rows += [(c, i, "user", "same") for c in range(500, 650) for i in range(3)]
    assert run(spark, rows, shards) == brute(chained(listed(rows)))
    assert run(spark, rows, shards, rebuild=False) == brute(listed(rows))


def test_small_tables(spark):
    assert run(spark, [], 3) == []
    assert run(spark, [(None, 1, "user", "x")], 3) == []
    one = [(11, 0, "user", "x")]
    assert run(spark, one, 3) == brute(chained(listed(one)))
    same = [(c, t, "user", "x") for c in range(0, 50, 5) for t in range(4)]
    assert run(spark, same, 3) == brute(chained(listed(same)))


def parentheses(rnd, pairs, deep):
    bits, depth, left = [True], 1, pairs - 1
    while depth:
        if left and (depth == 1 or rnd.random() < deep):
            bits.append(True)
            depth, left = depth + 1, left - 1
        else:
            bits.append(False)
            depth -= 1
        if depth == 1 and not left:
            bits.append(False)
            break
    return np.array(bits)


@pytest.mark.parametrize("block", [1, 3, 64])
@pytest.mark.parametrize("deep", [0.3, 0.5, 0.95])
def test_find_close(block, deep):
    rnd = random.Random(7)
    for pairs in (1, 2, 5, 63, 64, 65, 1000):
        bits = parentheses(rnd, pairs, deep)
        stack, want = [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                want[stack.pop()] = i
        opens = np.flatnonzero(bits)
        assert list(find_close(excess_of(bits), opens, block)) == [want[i] for i in opens]


def test_least_between():
    rnd = np.random.default_rng(4)
    values = rnd.integers(0, 1000, 300)
    start = rnd.integers(0, 300, 500)
    stop = np.minimum(300, start + rnd.integers(1, 300, 500))
    assert list(least_between(values, start, stop)) == [values[a:b].min() for a, b in zip(start, stop)]
