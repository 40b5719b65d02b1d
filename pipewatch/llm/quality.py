"""Quality rules: statistics of whole texts, fixed base rules, and boosted trees over the statistics.

The trees are fitted on a bounded sample of labelled documents, with shares of symbols, repeated
words and repeated lines allowed to lower the probability only. Words are runs of anything but
ASCII white space.

Defined results: NULL text has no words and fails the base rules; documents and labels whose id is
NULL are not used for fitting; of labels that repeat an id the largest counts; with no labels, or
labels of one kind only, the base rules alone decide; an empty table gives an empty one; columns
other than key and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pipewatch.llm.boosting import Forest, fit_forest
from pipewatch.llm.common import written

# Labelled documents that are collected to fit the trees.
MAX_FITTED = 50_000
KEEP_FROM = 0.5
MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_lines", "n_capitals", "n_digits", "n_marks", "n_distinct_words", "n_stutters"]
#: Per feature, how the probability of good quality may change with it.
MONOTONE = {
    "log_words": 0,
    "word_length": 0,
    "symbol_share": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "stutter_share": -1,
    "capital_share": 0,
    "digit_share": 0,
    "mark_share": 0,
    "distinct_share": 0,
    "words_per_line": 0,
}

_SPACE = np.array([9, 10, 11, 12, 13, 32])
_LEADING = np.array([b for b in range(256) if b & 0xC0 != 0x80])


def _byte_counts(text: bytes) -> np.ndarray:
    total = np.zeros(256, np.int64)
    for at in range(0, len(text), 1 << 20):
        total += np.bincount(np.frombuffer(text[at : at + (1 << 20)], np.uint8), minlength=256)
    return total


def repeated_words(ids: np.ndarray, kinds: int) -> int:
    """Words in windows of three words that are found twice or more."""
    if len(ids) < 3:
        return 0
    pairs = ids[:-2] * kinds + ids[1:-1]
    if kinds > 2_000_000:
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, place, count = np.unique(pairs * kinds + ids[2:], return_inverse=True, return_counts=True)
    again = count[place] > 1
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[shift : len(ids) - 2 + shift] |= again
    return int(covered.sum())


def statistics_of(text: bytes) -> tuple[int, ...]:
    """``STATISTICS`` and ``EXTRA`` of one whole text."""
    words, counts = text.split(), _byte_counts(text)
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        int(counts[_LEADING].sum() - counts[_SPACE].sum()),
        int(counts[list(SYMBOLS)].sum()),
        len(lines) - len(set(lines)),
        repeated_words(ids, max(1, len(known))),
        len(lines),
        int(counts[65:91].sum()),
        int(counts[48:58].sum()),
        int(counts[list(b"!?")].sum()),
        len(known),
        int((ids[1:] == ids[:-1]).sum()),
    )


def text_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, ``STATISTICS`` and ``EXTRA`` of every document."""
    narrow = docs.select(F.col(key), F.col(text))
    kind = narrow.schema[0].dataType.simpleString()
    names = STATISTICS + EXTRA

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics_of(t or b"") for t in batch.column(1).cast(pa.binary()).to_pylist()]
            numbers = np.array(rows, np.int64).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, numbers.T.copy())], [key, *names])

    return narrow.mapInArrow(measure, f"`{key}` {kind}, " + ", ".join(f"{n} bigint" for n in names))


def features(stats: pd.DataFrame) -> np.ndarray:
    s = {c: stats[c].to_numpy(np.float64) for c in STATISTICS + EXTRA}
    words, lines, chars = np.maximum(s["n_words"], 1), np.maximum(s["n_lines"], 1), np.maximum(s["word_chars"], 1)
    columns = {
        "log_words": np.log1p(s["n_words"]),
        "word_length": s["word_chars"] / words,
        "symbol_share": s["n_symbols"] / words,
        "dup_line_share": s["n_dup_lines"] / lines,
        "repeat_share": s["n_repeat_words"] / words,
        "stutter_share": s["n_stutters"] / words,
        "capital_share": s["n_capitals"] / chars,
        "digit_share": s["n_digits"] / chars,
        "mark_share": s["n_marks"] / words,
        "distinct_share": s["n_distinct_words"] / words,
        "words_per_line": words / lines,
    }
    return np.stack([columns[name] for name in MONOTONE], axis=1)


def fit_quality(stats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", limit: int = MAX_FITTED) -> Forest | None:
    """Trees over at most about ``limit`` labelled documents, chosen by a hash of their id."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).alias("_good"))
    total = known.count()
    if not total:
        return None
    share = min(1.0, limit / total)
    chosen = known.where(F.pmod(F.xxhash64(key), F.lit(1 << 20)) < int(share * (1 << 20)))
    sample = stats.join(chosen, key).select("_good", *STATISTICS, *EXTRA).toPandas()
    if sample["_good"].nunique() < 2:
        return None
    return fit_forest(features(sample), (sample["_good"] > 0).to_numpy(float), list(MONOTONE.values()))


def judge(stats: DataFrame, forest: Forest | None, keep_from: float = KEEP_FROM) -> DataFrame:
    """``stats`` plus ``base_failed``, ``quality`` (probability; NULL without trees) and ``kept``."""
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = stats.withColumn("base_failed", base)
    if forest is None:
        return judged.withColumn("quality", F.lit(None).cast("double")).withColumn("kept", ~F.col("base_failed"))

    @F.pandas_udf("double")
    def probability(columns: pd.DataFrame) -> pd.Series:
        return pd.Series(forest.probability(features(columns)))

    judged = judged.withColumn("quality", probability(F.struct(*STATISTICS, *EXTRA)))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= keep_from))


def quality_rules(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Statistics, probability and verdict of every document; trees learn from ``labels``."""
    stats = written(text_statistics(docs, key, text), "text-statistics")
    return judge(stats, fit_quality(stats, labels, key))
