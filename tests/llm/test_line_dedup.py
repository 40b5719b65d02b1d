"""Line deduplication: equal to counting all lines, runs by level, odd rows defined."""

import random

import pytest
from pyspark.sql import functions as F

from pipewatch.llm.line_dedup import LineRuns, drop_repeated_lines, line_hashes, lost_lines

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = [f"this is the long line number {i} of all" for i in range(30)]


def key_of(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(FOLD)


def brute(rows, at_least=3, points=20):
    holders = {}
    for doc, text in rows:
        for k in {key_of(line) for line in (text or "").split("\n")}:
            if len(k) >= points:
                holders.setdefault(k, []).append(-1 if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        own = -1 if doc is None else doc
        stay = [x for x in lines if not (len(holders.get(key_of(x), ())) >= at_least and own < max(holders[key_of(x)]))]
        out.append((doc, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


def documents(n, seed=4):
    rnd = random.Random(seed)
    odd = ["", "short", " \t" + LONG[0].upper() + "\r", "ÀÉ" * 9 + "x", "ÀÉ" * 9 + "xy", "àé" * 9 + "XY", LONG[1] + " ", "\x0b" + LONG[1] + "\x0c"]
    return [(i, "\n".join(rnd.choices(LONG[: 8 + i % 22] + odd + [f"a line that only document {i} has"], k=rnd.randrange(0, 12)))) for i in range(n)]


def run(spark, rows, **named):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS hi", "3 AS lost", "4 AS _probes", "5 AS batch")
    return sorted(map(tuple, drop_repeated_lines(df, **named).collect()), key=repr)


@pytest.mark.parametrize("batches", [1, 5])
def test_equals_counting_all_lines(spark, batches):
    rows = documents(300)
    rows += rows[:5] + [(None, "\n".join(LONG[:3])), (None, None), (900, None), (901, ""), (902, "\n"), (903, "\n".join(LONG * 2000))]
    # Held by rows without an id only: nothing is larger.
    rows += [(None, "only rows without an id hold this")] * 3
    assert run(spark, rows, batches=batches) == brute(rows)
    assert run(spark, rows[:40], at_least=2, min_points=5, batches=batches) == brute(rows[:40], 2, 5)


def test_a_line_of_most_documents_and_empty_tables(spark):
    rows = [(i, f"the very same line in every text\n{i} is the number of this document") for i in range(2000)]
    got = run(spark, rows)
    assert got == brute(rows) and sum(r[2] for r in got) == 1999
    assert run(spark, rows[:0]) == []
    assert run(spark, [(1, None)]) == [(1, 1, 0, "")]


def test_runs_are_levelled_and_disjoint(spark):
    runs = LineRuns(spark, buckets=3, fanout=2)
    rows = documents(140)
    batches = [rows[i : i + 20] for i in range(0, 140, 20)]
    for b in batches:
        runs.add(line_hashes(spark.createDataFrame(b, "doc_id long, text string")))
    # Seven batches in binary: one run in each of three levels.
    assert [len(level) for level in runs.first] == [1, 1, 1]
    first = [tuple(r) for level in runs.first for n in level for r in spark.table(n).select("hi", "lo").collect()]
    assert len(first) == len(set(first)) == line_hashes(spark.createDataFrame(rows, "doc_id long, text string")).select("hi", "lo").distinct().count()
    plan = spark.table(runs.first[0][0]).join(spark.table(runs.first[2][0]).hint("merge"), ["hi", "lo"], "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "hashpartitioning" not in plan
    counted = line_hashes(spark.createDataFrame(rows, "doc_id long, text string")).groupBy("hi", "lo").agg(F.count("*").alias("n"), F.max("id").alias("top")).where("n >= 3")
    assert sorted(runs.repeated(3).collect()) == sorted(counted.collect())
    runs.forget()
    assert lost_lines(spark.createDataFrame([], "id long, hi long, lo long"), counted).count() == 0
