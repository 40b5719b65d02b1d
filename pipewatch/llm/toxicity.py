"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

1. Voters. A short seed lexicon, words and word beginnings that mark toxic training documents far
   beyond chance, and two pattern voters (several hits, dense hits). A voter says "toxic" or nothing.
2. Label model. Each voter has a rate among toxic and among other documents; voters that fire
   together within a class beyond independence share their weight. Rates and correlations are
   estimated by expectation maximisation over the votes of all documents, labels of training rows
   held fixed. Sums of votes and of the pairs of votes that occur are made by the tasks; only these return.
3. Classifier. A logistic regression on the voters' hits is fitted to the posterior labels of a
   bounded sample of documents. It alone gives the score.

Only training labels are ever read; language, source and id are no inputs. Defined results: NULL
text counts as empty and scores like a text without hits; a NULL id is never labelled; of labels
that repeat an id the largest counts; without labels the seed lexicon works with default rates; an
empty table gives an empty one; columns other than key and text are not read by the score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pipewatch.llm.common import whole_text, written

# Labelled documents from which words are learned, voters, and documents that fit the classifier.
MAX_LABELLED = 100_000
MAX_FITTED = 30_000
ROUNDS = 3
REJECT_FROM = 0.3
# Words beginnings of these lengths vote too.
BEGINNINGS = (4, 5, 6, 7)
# Distinct texts (as far as 64 marks tell) that must have a word before it may vote.
MIN_TEXTS = 3
DEFAULT_RATE = 0.1
# Voters beside the lexicon: several words hit, a large share of the words hit.
PATTERNS = 2
# Terms that a task counts before it hands on their sums.
TERMS_HELD = 50_000
# Pairs of votes that a task holds before it adds them up, and rows of the classifier's sample looked at together.
PAIRS_HELD = 1 << 18
SAMPLE_ROWS = 4096
# Different votes that one task sums up.
PATTERNS_PER_TASK = 50_000

SEED = """arsehole asshole bastard bitch bullshit clown crap creep cretin damn degenerate disgusting dumb dumbass
filth filthy freak fuck garbage hate hideous idiot idiotic imbecile jerk loser lunatic moron moronic nasty
parasite pathetic pig punk rat repulsive retard ridiculous scum scumbag shit sicko sleazy slob slut stupid
sucker swine trash ugly vermin vile weirdo whore worthless wretched""".split()

_WORD = re.compile(r"[^\W\d_]+")


def terms_of(word: str) -> list[str]:
    """The word itself and its beginnings (marked by a star)."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


# -- words that mark toxic documents -------------------------------------------


def term_counts(labelled: DataFrame) -> DataFrame:
    """Per term: ``toxic`` and ``other`` documents that have it, and ``texts``, the marks of distinct toxic texts.

    Input columns: ``text`` and ``label``. Each task adds up its own documents first.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, list[int]] = {}

        def out() -> pd.DataFrame:
            rows = [(t, *n) for t, n in sums.items()]
            sums.clear()
            return pd.DataFrame(rows, columns=["term", "toxic", "other", "texts"])

        for frame in frames:
            for text, label, mark in zip(frame["text"], frame["label"], frame["mark"]):
                words = set(_WORD.findall(text.lower()))
                for term in {t for w in words for t in terms_of(w)}:
                    own = sums.setdefault(term, [0, 0, 0])
                    if label:
                        own[0] += 1
                        own[2] |= 1 << mark
                    else:
                        own[1] += 1
                if len(sums) > TERMS_HELD:
                    yield out()
        yield out()

    marked = labelled.select("text", "label", F.pmod(F.xxhash64("text"), F.lit(62)).cast("int").alias("mark"))
    parts = marked.mapInPandas(count, "term string, toxic bigint, other bigint, texts bigint")
    return parts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"), F.bit_or("texts").alias("texts"))


def learn_lexicon(labelled: DataFrame) -> list[str]:
    """The seed and all terms that mark toxic documents beyond chance, the most frequent first.

    A term needs some toxic labels of its own, so at most ``MAX_LABELLED`` labels bound their number.

    Beyond chance: Chernoff's bound on so many toxic documents among those with the term, times
    the number of terms, is below e^-3, and nine of ten documents with the term are toxic.
    """
    sums = labelled.agg(F.sum("label"), F.count(F.lit(1))).first()
    toxic, total = int(sums[0] or 0), int(sums[1])
    lexicon = list(SEED)
    if 0 < toxic < total:
        counts = written(term_counts(labelled), "toxic-terms")
        rate, n = toxic / total, F.col("toxic") + F.col("other")
        share = F.col("toxic") / n
        rest = 1 - share
        beyond = share * F.log(share / rate) + F.when(rest > 0, rest * F.log(rest / (1 - rate))).otherwise(0.0)
        chance = float(np.log(max(2, counts.count()))) + 3
        found = (
            counts.where((F.col("toxic") >= 0.9 * n) & (F.bit_count("texts") >= MIN_TEXTS) & (n * beyond > chance))
            .where(~F.col("term").isin(SEED))
            .orderBy(F.desc("toxic"), "term")
        )
        lexicon += [r.term for r in found.select("term").collect()]
    return lexicon


# -- votes -----------------------------------------------------------------------


def vote(text: Column, lexicon: list[str]) -> Column:
    """Struct of ``voters``, ``hits`` and ``words``; the pattern voters come after the lexicon."""
    index = {t: i for i, t in enumerate(lexicon)}
    heads = {t[: BEGINNINGS[0]] for t in index if t[-1] == "*"}
    several, dense = len(lexicon), len(lexicon) + 1

    @F.pandas_udf("voters array<int>, hits array<int>, words bigint")
    def votes(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            words = _WORD.findall(text.lower())
            hits: dict[int, int] = {}
            total = 0
            for w in words:
                if w not in index and (len(w) <= BEGINNINGS[0] or w[: BEGINNINGS[0]] not in heads):
                    continue
                fired = [index[t] for t in terms_of(w) if t in index]
                for v in fired:
                    hits[v] = hits.get(v, 0) + 1
                total += bool(fired)
            if total > 1:
                hits[several] = total
            if total > 0.02 * len(words):
                hits[dense] = total
            kinds = sorted(hits)
            out.append((kinds, [hits[v] for v in kinds], len(words)))
        return pd.DataFrame(out, columns=["voters", "hits", "words"])

    return votes(text)


# -- the label model -------------------------------------------------------------


@dataclass
class LabelModel:
    """``rates`` has the firing rates of each voter among other (0) and toxic (1) documents, ``silent`` the
    shares of documents in which none fires.

    Whether any voter fires is one piece of evidence; which ones do is another, given that some do.
    The silence of a word is none: most keep silent only because a text is in another language. The
    silence of a pattern voter, the last ``PATTERNS``, counts beside firing words.
    """

    prior: float
    rates: np.ndarray
    silent: np.ndarray
    weights: np.ndarray

    def posterior(self, voters: list[np.ndarray]) -> np.ndarray:
        loud = 1 - self.silent
        fire = self.weights * (np.log(self.rates[1] / loud[1]) - np.log(self.rates[0] / loud[0]))
        odds = np.log(self.prior / (1 - self.prior))
        given = np.clip(self.rates / loud[:, None], 1e-6, 1 - 1e-3)
        quiet = self.weights * (np.log1p(-given[1]) - np.log1p(-given[0]))
        quiet[: len(quiet) - PATTERNS] = 0
        fire = fire - quiet
        none, some = odds + np.log(self.silent[1] / self.silent[0]), odds + np.log(loud[1] / loud[0]) + quiet.sum()
        logits = np.array([some + fire[v].sum() if len(v) else none for v in voters])
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))

    @classmethod
    def start(cls, size: int) -> LabelModel:
        rates = np.stack([np.full(size, 1e-3), np.full(size, 0.2)])
        return cls(DEFAULT_RATE, rates, np.array([0.98, 0.2]), np.ones(size))


@dataclass
class Pairs:
    """Sums of the pairs of votes that occur, by ``code`` (first voter times the number of voters, plus second, first <= second)."""

    code: np.ndarray
    n: np.ndarray

    @classmethod
    def of(cls, codes: list[np.ndarray], n: list[np.ndarray]) -> Pairs:
        if not codes:
            return cls(np.zeros(0, np.int64), np.zeros(0))
        code, place = np.unique(np.concatenate(codes), return_inverse=True)
        return cls(code, np.bincount(place, np.concatenate(n), len(code)))


def class_sums(patterns: DataFrame, model: LabelModel | None, size: int) -> tuple[np.ndarray, np.ndarray, list[Pairs]]:
    """Per class: documents, those without votes, and the pairs of votes (votes are pairs with themselves).

    ``patterns`` has ``voters``, ``label`` (NULL: not known) and ``n`` documents. Without a model
    only labelled documents count. Each task returns its own sums of the pairs it has seen.
    """

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals, none = np.zeros(2), np.zeros(2)
        codes: list[list[np.ndarray]] = [[], []]
        parts: list[list[np.ndarray]] = [[], []]
        held, most = 0, PAIRS_HELD
        for frame in frames:
            voters = [np.sort(np.asarray(v, np.int64)) for v in frame["voters"]]
            label = frame["label"].to_numpy(float)
            known = ~np.isnan(label)
            q = np.where(known, np.nan_to_num(label), 0.0 if model is None else model.posterior(voters))
            n = frame["n"].to_numpy(float)
            for own, v, toxic, known_one in zip(n, voters, q, known):
                if model is None and not known_one:
                    continue
                one, two = np.triu_indices(len(v))
                code = v[one] * size + v[two]
                for c, part in ((0, own * (1 - toxic)), (1, own * toxic)):
                    totals[c] += part
                    none[c] += 0 if len(v) else part
                    if len(v) and part > 1e-9:
                        codes[c].append(code)
                        parts[c].append(np.full(len(code), part))
                        held += len(code)
                if held > most:
                    sums = [Pairs.of(codes[c], parts[c]) for c in (0, 1)]
                    codes, parts, held = [[x.code] for x in sums], [[x.n] for x in sums], 0
                    # Adding up costs as much as all sums so far, so as many pairs come before the next time.
                    most = max(PAIRS_HELD, *(len(x.code) for x in sums))
        for c in (0, 1):
            x = Pairs.of(codes[c], parts[c])
            yield pd.DataFrame({"c": c, "code": np.concatenate([[-1, -2], x.code]).astype(np.int64), "n": np.concatenate([[totals[c], none[c]], x.n])})

    summed = patterns.mapInPandas(add, "c int, code bigint, n double").groupBy("c", "code").agg(F.sum("n").alias("n")).toPandas()
    totals, none, sums = np.zeros(2), np.zeros(2), []
    for c in (0, 1):  # as many rows as pairs of voters occur
        code, n = (summed.loc[summed["c"] == c, name].to_numpy() for name in ("code", "n"))
        totals[c], none[c] = n[code == -1].sum(), n[code == -2].sum()
        sums.append(Pairs.of([code[code >= 0]], [n[code >= 0]]))
    return totals, none, sums


def estimate(totals: np.ndarray, none: np.ndarray, sums: list[Pairs], size: int, prior_rows: float = 2.0) -> LabelModel:
    """Rates, and weights from the correlations of the voters within each class."""
    fired = np.zeros((2, size))
    for c, x in enumerate(sums):
        one, two = np.divmod(x.code, size)
        fired[c, one[one == two]] = x.n[one == two]
    usual = np.stack([np.full(size, 1e-4), np.full(size, 0.05)])
    rates = (fired + prior_rows * usual) / (totals[:, None] + prior_rows)
    rates = np.clip(rates, 1e-6, 1 - 1e-6)
    rates[1] = np.maximum(rates[1], rates[0])  # a voter never speaks against toxicity
    # Voters that never fire together correlate negatively, so the pairs that occur are all that count.
    codes, excess = [], []
    for c, x in enumerate(sums):
        if totals[c] > 0:
            one, two = np.divmod(x.code, size)
            mean = fired[c] / totals[c]
            spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
            correlation = (x.n / totals[c] - mean[one] * mean[two]) / (spread[one] * spread[two])
            # Voters of one language go together a little; only those that say nearly the same share a vote.
            same = (one != two) & (np.minimum(fired[c, one], fired[c, two]) >= 3) & (correlation > 0.5)
            codes.append(x.code[same])
            excess.append(correlation[same])
    shared = np.zeros(size)
    if codes:
        code, place = np.unique(np.concatenate(codes), return_inverse=True)
        most = np.zeros(len(code))
        np.maximum.at(most, place, np.concatenate(excess))
        for end in np.divmod(code, size):
            np.add.at(shared, end, most)
    prior = float(np.clip(totals[1] / max(totals.sum(), 1), 1e-3, 0.5))
    silent = (none + prior_rows * np.array([0.98, 0.2])) / (totals + prior_rows)
    return LabelModel(prior, rates, np.clip(silent, 1e-6, 1 - 1e-6), 1 / (1 + shared))


def fit_label_model(patterns: DataFrame, size: int, rounds: int = ROUNDS) -> LabelModel:
    known = class_sums(patterns, None, size)
    model = estimate(*known, size) if known[0].min() > 0 else LabelModel.start(size)
    for _ in range(rounds):
        model = estimate(*class_sums(patterns, model, size), size)
    return model


# -- the classifier ----------------------------------------------------------------


@dataclass
class Classifier:
    lexicon: list[str]
    weights: np.ndarray  # per voter, then hits, density, 1

    def features(self, voters, hits, words) -> np.ndarray:
        size = len(self.lexicon) + 2
        x = np.zeros((len(words), size + 3))
        for row, (v, h, n) in enumerate(zip(voters, hits, words)):
            if len(v):
                x[row, np.asarray(v, np.int64)] = 1
                most = max(h)
                x[row, size], x[row, size + 1] = np.log1p(most), np.log1p(100 * most / max(n, 1))
        x[:, -1] = 1
        return x

    def score(self, voters, hits, words) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(voters, hits, words) @ self.weights, -30, 30)))


def fit_classifier(lexicon: list[str], sample: pd.DataFrame, posterior: np.ndarray, l2: float = 1.0, steps: int = 25) -> Classifier:
    """Logistic regression on soft labels by Newton steps; the intercept is not shrunk."""
    model = Classifier(lexicon, np.zeros(len(lexicon) + 5))
    if not len(sample):
        model.weights[-1] = np.log(DEFAULT_RATE / (1 - DEFAULT_RATE))
        model.weights[len(lexicon) + 2] = 4.0
        return model
    voters, hits, words = sample["voters"].tolist(), sample["hits"].tolist(), sample["words"].to_numpy()
    w = model.weights
    shrink = np.full(len(w), l2)
    shrink[-1] = 1e-6
    for _ in range(steps):
        bend, slope = np.diag(shrink + 1e-9), -shrink * w
        for at in range(0, len(words), SAMPLE_ROWS):
            own = slice(at, at + SAMPLE_ROWS)
            x = model.features(voters[own], hits[own], words[own])
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            bend += (x * (p * (1 - p))[:, None]).T @ x
            slope += x.T @ (posterior[own] - p)
        step = np.linalg.solve(bend, slope)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    model.weights = w
    return model


def fit_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Classifier:
    """Learn from all of ``docs`` and from ``labels``, which must be training labels only."""
    narrow = docs.select(F.col(key).alias("key"), whole_text(text).alias("text"))
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    known = known.groupBy(F.col(key).alias("of")).agg((F.max(label) > 0).cast("int").alias("label"))
    total = known.count()
    share = min(1.0, MAX_LABELLED / max(total, 1))
    # At most about MAX_LABELLED rows of two numbers, whatever the size of ``labels``.
    chosen = F.broadcast(known.where(F.pmod(F.xxhash64("of"), F.lit(1 << 20)) < int(share * (1 << 20))))
    lexicon = learn_lexicon(narrow.join(chosen, F.col("key") == F.col("of")).select("text", "label"))
    voted = narrow.join(chosen, F.col("key") == F.col("of"), "left").select(vote(F.col("text"), lexicon).alias("v"), "label")
    patterns = voted.groupBy("v", "label").agg(F.count(F.lit(1)).alias("n")).select("v.*", "label", "n")
    patterns = written(patterns, "toxic-votes")
    size = len(lexicon) + PATTERNS
    votes = written(patterns.groupBy("voters", "label").agg(F.sum("n").alias("n")), "toxic-patterns")
    # Each task returns the pairs it has seen, so there should be no more tasks than rows ask for.
    model = fit_label_model(votes.coalesce(-(-votes.count() // PATTERNS_PER_TASK) or 1), size)
    # Equal votes are one row here; rows with and without hits each give up to half the sample.
    parts = []
    for has in (F.size("voters") > 0, F.size("voters") == 0):
        own = patterns.where(has)
        share = min(1.0, MAX_FITTED / 2 / max(own.count(), 1))
        parts.append(own.where(F.pmod(F.xxhash64("voters", "hits", "words"), F.lit(1 << 20)) < int(share * (1 << 20))).select("voters", "hits", "words"))
    sample = parts[0].unionByName(parts[1]).toPandas()
    return fit_classifier(lexicon, sample, model.posterior([np.asarray(v, np.int64) for v in sample["voters"]]))


def toxicity(text: Column, model: Classifier) -> Column:
    """The score of a text, from 0 to 1."""

    @F.pandas_udf("double")
    def score(votes: pd.DataFrame) -> pd.Series:
        return pd.Series(model.score(votes["voters"], votes["hits"], votes["words"].to_numpy()))

    return score(vote(F.coalesce(text, F.lit("")), model.lexicon))


def held_out(key: str = "doc_id") -> Column:
    """Whether labels of this row are kept from learning; a NULL id counts as the empty string."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 4 == 2
