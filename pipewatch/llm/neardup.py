"""Near-duplicate documents by MinHash bands and sequential Bayesian verification.

Texts become sets of shingles; documents with equal sets are one node. A node's signature has
``BANDS`` bands of ``ROWS`` values, and nodes that share a band are candidates. Candidates are
compared in batches of signature values: after each batch a pair goes once the posterior chance
that its similarity reaches the threshold is below ``MISS``. Survivors are verified on full sets.

No pair list of a group is ever written out. In a first round each bucket offers only a spanning
forest of its surviving pairs, the most similar first; these are verified, and what they link is
contracted. In a second round the buckets that still hold several components first tell by signatures
which nodes have a surviving pair with another component; only these bring their full sets along.
There a task verifies the surviving pairs between different components itself, the
most similar first, and gives only the links that join two components. After that, every pair that
shares a band and survives the signature test has been verified or lies inside one component.
Large buckets are dealt out in pairs of blocks, so no task holds a whole one.

Defined results: NULL and empty texts have no shingles and link with nothing; a NULL id counts
only where all ids of a component are NULL; rows that repeat an id and a text are in one component,
and all rows whose id is the smallest are kept; very long texts are shingled whole; an empty table gives an
empty one; columns other than key and text, of any name, are not read and come back unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from pipewatch.llm.bloom import bit_table, filter_bits, with_hits
from pipewatch.llm.common import whole_text, with_plain_names, written
from pipewatch.llm.components import connected
from pipewatch.session import durable, small_batches

WORDS = 5
BANDS, ROWS = 24, 5
SIZE = BANDS * ROWS
BATCH = 24
# Nodes of a bucket that one task compares with one another, by signatures and by full sets.
BLOCK = 2048
SET_BLOCK = 512
# A pair is pruned when the chance that it reaches the threshold is below this.
MISS = 1e-4
# What is told of a node that may have a link to another component.
ENDS = ["bucket", "band", "node", "root"]
# Words whose hashes a worker remembers; shingles hashed at a time; pairs compared at a time.
REMEMBERED = 60_000
CHUNK = 2048
PAIRS = 1 << 13
# Surviving pairs that a task holds before only their spanning forest is kept; rows that a task hands to Python at a time.
PAIRS_HELD = 1 << 18
BATCH_ROWS = 1000


# -- shingles and signatures -----------------------------------------------------


class Shingler:
    def __init__(self, words: int = WORDS, size: int = SIZE):
        rng = np.random.default_rng(20_240_501)
        self.words = words
        self.place = rng.integers(1, 2**63, words, dtype=np.uint64) | np.uint64(1)
        self.factor = rng.integers(1, 2**63, size, dtype=np.uint64) | np.uint64(1)
        self.shift = rng.integers(0, 2**63, size, dtype=np.uint64)
        self.known: dict[bytes, int] = {}

    def shingles(self, text: bytes) -> np.ndarray:
        """Sorted distinct 64-bit hashes; with fewer words than a shingle has, the whole sequence is one."""
        words = text.lower().split()  # of bytes: A-Z, and ASCII white space
        if not words:
            return np.zeros(0, np.uint64)
        if len(words) < self.words:
            return np.array([xxhash.xxh3_64_intdigest(b"\n".join(words), len(words))], np.uint64)
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        try:
            hashes = [known[w] for w in words]
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            hashes = [known[w] for w in words]
        h = np.array(hashes, np.uint64)
        n = len(h) - self.words + 1
        s = np.zeros(n, np.uint64)
        for i, factor in enumerate(self.place):
            s += h[i : i + n] * factor
        s ^= s >> np.uint64(29)
        s *= np.uint64(0xBF58476D1CE4E5B9)
        s ^= s >> np.uint64(32)
        return np.unique(s)

    def signature(self, shingles: np.ndarray) -> bytes:
        least = np.full(len(self.factor), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(shingles), CHUNK):
            part = shingles[at : at + CHUNK]
            # One hash function at a time stays in the cache.
            for k in range(len(least)):
                least[k] = min(least[k], (part * self.factor[k] + self.shift[k]).min())
        return (least >> np.uint64(32)).astype("<u4").tobytes()


@lru_cache(maxsize=1)
def _shingler() -> Shingler:
    return Shingler()


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, ``text_hash``, ``n_shingles``, and per non-empty set its 128-bit ``set_id`` and ``signature``."""
    narrow = docs.select(F.col(key), whole_text(text).alias("text"), F.xxhash64(whole_text(text)).alias("text_hash"))
    kind = narrow.schema[0].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _shingler()
        for batch in batches:
            size, ids, marks = [], [], []
            for raw in batch.column(1).cast(pa.binary()).to_pylist():
                s = own.shingles(raw)
                size.append(len(s))
                ids.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                marks.append(own.signature(s) if len(s) else None)
            columns = [batch.column(0), batch.column(2), pa.array(size, pa.int64()), pa.array(ids, pa.binary()), pa.array(marks, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [key, "text_hash", "n_shingles", "set_id", "signature"])

    return narrow.mapInArrow(sign, f"`{key}` {kind}, text_hash bigint, n_shingles bigint, set_id binary, signature binary")


# -- candidates --------------------------------------------------------------------


def least_matches(percent: int, size: int = SIZE, batch: int = BATCH, miss: float = MISS) -> dict[int, int]:
    """After so many values, the matches below which a pair is pruned.

    With a uniform prior, the chance that the similarity is at least t after m matches of n is
    that of at most m successes in n + 1 trials of chance t.
    """
    t, out = percent / 100, {}
    for n in range(batch, size + 1, batch):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out[n] = m
    return out


def _survivors(sig: np.ndarray, p: np.ndarray, q: np.ndarray, least: dict[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs that no batch prunes, with their matches."""
    matches, done = np.zeros(len(p), np.int64), 0
    for n, need in least.items():
        matches += (sig[p, done:n] == sig[q, done:n]).sum(axis=1)
        keep = matches >= need
        p, q, matches, done = p[keep], q[keep], matches[keep], n
    return p, q, matches


class _Forest:
    """Which of some numbers are joined already."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.parent[a] = b
        return a != b


def similar(x: bytes | pa.Buffer, y: bytes | pa.Buffer, percent: int) -> bool:
    """Whether two sorted shingle sets share at least ``percent`` hundredths of their union."""
    a, b = sorted((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), key=len)
    if 100 * len(a) < percent * len(b):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def candidate_pairs(groups: DataFrame, percent: int, ends: bool = False) -> DataFrame:
    """A spanning forest (``a`` < ``b``) of the surviving pairs of each group of ``groups``.

    Columns: ``bucket, one, two`` (the group: a pair of blocks), ``block``, ``band``, ``node``,
    ``root``, ``signature``; with ``shingles`` beside them, only pairs that the full sets verify
    enter the forest. Roots are the trees to begin with. A pair that shares several bands counts
    in the first of them. With ``ends`` the result is ``bucket``, ``band``, ``node``, ``root`` of the
    nodes that have a surviving pair with another root, once per group.
    """
    least = least_matches(percent)
    columns = ["bucket", "one", "two", "block", "band", "node", "root", "signature"]
    verify = "shingles" in groups.columns
    columns += ["shingles"] if verify else []

    def pairs_of(table: pa.Table) -> pa.RecordBatch:
        column = {n: table[n].to_numpy() for n in ("bucket", "one", "two", "block", "band", "node", "root")}
        marks = table["signature"].combine_chunks()
        marks = marks.chunk(0) if isinstance(marks, pa.ChunkedArray) else marks
        sig = np.frombuffer(b"".join(marks.to_pylist()), "<u4").reshape(-1, SIZE)
        changes = [np.diff(column[n]) != 0 for n in ("bucket", "one", "two")]
        group = np.concatenate([[0], np.cumsum(changes[0] | changes[1] | changes[2])])
        largest = int(np.bincount(group).max())
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        open_end = np.zeros(len(sig), bool)
        sets = table["shingles"] if verify else None

        def all_found() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int),) * 3

        def forest(p: np.ndarray, q: np.ndarray, matches: np.ndarray) -> list[int]:
            """Places of the pairs that join two trees of their group, the most similar first."""
            joined, current, keep = _Forest(), -1, []
            for i in np.lexsort((-matches, group[p])).tolist():
                one, two = int(p[i]), int(q[i])
                if group[one] != current:
                    joined, current = _Forest(), group[one]
                trees = joined.root(int(column["root"][one])), joined.root(int(column["root"][two]))
                if trees[0] != trees[1] and (not verify or similar(sets[one].as_buffer(), sets[two].as_buffer(), percent)):
                    joined.join(*trees)
                    keep.append(i)
            return keep

        def settle() -> None:
            if waiting:
                p, q, matches = _survivors(sig, *(np.concatenate(x) for x in zip(*waiting)), least)
                waiting.clear()
                shared = (sig[p] == sig[q]).reshape(-1, BANDS, ROWS).all(axis=2)
                first = shared.argmax(axis=1) == column["band"][p]
                if ends:
                    open_end[p[first]] = open_end[q[first]] = True
                    return
                found.append((p[first], q[first], matches[first]))
                if not verify and sum(len(x[0]) for x in found) > PAIRS_HELD:
                    # In the order of finding, pairs to come leave the same forest as with all pairs at once.
                    p, q, matches = all_found()
                    keep = np.sort(np.array(forest(p, q, matches), int))
                    found[:] = [(p[keep], q[keep], matches[keep])]

        held = 0
        for step in range(1, largest):
            p = np.flatnonzero(group[:-step] == group[step:])
            q = p + step
            across = (column["one"][p] == column["two"][p]) | (column["block"][p] != column["block"][q])
            apart = across & (column["root"][p] != column["root"][q])
            waiting.append((p[apart], q[apart]))
            held += int(apart.sum())
            if held > PAIRS:
                settle()
                held = 0
        settle()
        if ends:
            return pa.RecordBatch.from_arrays([pa.array(column[n][open_end]) for n in ENDS], ENDS)
        p, q, matches = all_found()
        keep = forest(p, q, matches)
        p, q = p[keep], q[keep]
        a, b = column["node"][p], column["node"][q]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not len(batch):
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            # The last group may go on in the next batch.
            last = np.flatnonzero(
                (np.diff(table["bucket"].to_numpy()) != 0) | (np.diff(table["one"].to_numpy()) != 0) | (np.diff(table["two"].to_numpy()) != 0)
            )
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield pairs_of(table.slice(0, cut))
            held = table.slice(cut)
        if held is not None and len(held):
            yield pairs_of(held)

    ordered = groups.repartition("bucket", "one", "two").sortWithinPartitions("bucket", "one", "two")
    return ordered.select(*columns).mapInArrow(search, "bucket bigint, band int, node bigint, root bigint" if ends else "a bigint, b bigint")


def _blocks(members: DataFrame, size: int) -> DataFrame:
    """One row per member and pair of blocks of its bucket (columns ``bucket, n, node``): ``one`` <= ``two``."""
    count = F.ceil(F.col("n") / size).cast("int")
    own = F.when(count > 1, F.pmod(F.xxhash64("node", F.lit("block")), count)).otherwise(0).cast("int")
    dealt = members.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), count - 1)))
    return dealt.withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other"))


# -- verification ------------------------------------------------------------------


def shingle_sets(docs: DataFrame, wanted: DataFrame, text: str = "text") -> DataFrame:
    """``set_id``, ``shingles`` of the texts whose hashes are in ``wanted`` (one column).

    A Bloom filter of the wanted hashes keeps the other texts from being shuffled; what passes by
    mistake is not looked up later. Texts that repeat become one row on the map side.
    """
    bits = filter_bits(wanted.count())
    table = bit_table(wanted, bits)
    narrow = docs.select(whole_text(text).alias("text"), F.xxhash64(whole_text(text)).alias("text_hash"))
    passed = with_hits(narrow, table, bits, F.col("text_hash"), "_hit").where("_hit")
    single = passed.groupBy("text_hash").agg(F.min("text").alias("text"), F.max("text").alias("other"))
    # Two texts with one hash are both looked up.
    texts = single.select(F.explode(F.array_distinct(F.array("text", "other"))).alias("text"))

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _shingler()
        for batch in batches:
            sets = [own.shingles(raw).tobytes() for raw in batch.column(0).cast(pa.binary()).to_pylist()]
            ids = [xxhash.xxh3_128_digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(sets, pa.binary())], ["set_id", "shingles"])

    return texts.mapInArrow(shingle, "set_id binary, shingles binary")


def sets_of(used: DataFrame, nodes: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """``node``, ``shingles`` of the nodes in ``used``. ``nodes`` has ``node``, ``set_id``, ``text_hash``."""
    used = durable(nodes.select("node", "set_id", "text_hash").join(used.distinct(), "node"))
    sets = shingle_sets(docs, used.select("text_hash"), text).dropDuplicates(["set_id"])
    return written(used.join(sets, "set_id").select("node", "shingles"), "shingle-sets")


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, percent: int, text: str) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")), nodes, docs, text)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = [similar(x.as_buffer(), y.as_buffer(), percent) for x, y in zip(batch.column(2), batch.column(3))]
            mask = pa.array(mask, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    of = lambda end: sets.select(F.col("node").alias(end), F.col("shingles").alias(f"of_{end}"))
    joined = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "of_a", "of_b")
    return joined.mapInArrow(compare, "a bigint, b bigint")


# -- the whole -----------------------------------------------------------------------


def near_duplicates(docs: DataFrame, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, ``n_shingles``, ``component_id`` (smallest key reachable), ``kept``.

    Documents link when their sets' intersection is at least ``percent`` hundredths of their union.
    """
    return _decisions(docs, percent, key, text).drop("text_hash")


def _decisions(docs: DataFrame, percent: int, key: str, text: str) -> DataFrame:
    with small_batches(docs.sparkSession, BATCH_ROWS):
        signed, ids = _components(docs, percent, key, text)
    narrow = signed.select(key, "text_hash", "n_shingles", "set_id")
    linked = narrow.where("set_id IS NOT NULL").join(ids, "set_id").drop("set_id")
    alone = narrow.where("set_id IS NULL").select(key, "text_hash", "n_shingles", F.col(key).alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))


def _components(docs: DataFrame, percent: int, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The documents' signatures, and ``set_id``, ``component_id`` of all sets; both are durable."""
    signed = written(signatures(docs, key, text), "signatures")
    sets = signed.where("set_id IS NOT NULL").groupBy("set_id").agg(
        F.min(key).alias("least"), F.min("text_hash").alias("text_hash"), F.first("signature").alias("signature")
    )
    sets = written(sets, "shingle-set-ids")
    # Durable rows keep their number; hashed, it is an id without order.
    nodes = sets.withColumn("node", F.xxhash64(F.monotonically_increasing_id()))
    nodes = written(nodes, "nodes")
    bands = F.expr(
        f"transform(sequence(0, {BANDS - 1}), b -> struct(b AS band, xxhash64(b, substring(signature, b * {4 * ROWS} + 1, {4 * ROWS})) AS bucket))"
    )
    placed = nodes.select("node", F.inline(bands))
    crowds = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    crowds = durable(crowds)
    members = written(placed.join(crowds, "bucket"), "bucket-members")
    marks = nodes.select("node", "signature")

    first = _blocks(members, BLOCK).join(marks, "node").withColumn("root", F.col("node"))
    tried = written(candidate_pairs(first, percent).distinct(), "first-pairs")
    links = durable(verified(tried, nodes, docs, percent, text))
    roots = connected(links)

    labelled = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    labelled = written(labelled, "labelled-members")
    mixed = labelled.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    again = labelled.join(durable(mixed.select("bucket")), "bucket")
    # Signatures tell which nodes may link to another component; the sets of all others stay where they are.
    open_ends = written(candidate_pairs(_blocks(again, BLOCK).join(marks, "node"), percent, ends=True).distinct(), "open-ends")
    crowds = durable(open_ends.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")))
    sets = sets_of(open_ends.select("node"), nodes, docs, text)
    second = _blocks(open_ends.join(crowds, "bucket"), SET_BLOCK).join(marks.join(sets, "node"), "node")
    more = durable(candidate_pairs(second, percent).distinct())
    if more.head(1):
        roots = connected(links.unionByName(more))

    comp = nodes.select("node", "set_id", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    comp = durable(comp.select("set_id", "root", "least"))
    smallest = durable(comp.groupBy("root").agg(F.min("least").alias("component_id")))
    ids = durable(comp.join(smallest, "root").select("set_id", "component_id"))
    return signed, ids


def drop_near_duplicates(docs: DataFrame, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are kept, whole. Only documents that may have to go are shuffled."""
    return with_plain_names(docs, lambda d, key, text: _drop(d, percent, key, text), key=key, text=text)


def _drop(docs: DataFrame, percent: int, key: str, text: str) -> DataFrame:
    of_row = F.xxhash64(F.xxhash64(F.col(key)), F.xxhash64(whole_text(text)))
    gone = _decisions(docs, percent, key, text).where("NOT kept")
    gone = durable(gone.select(F.xxhash64(F.xxhash64(F.col(key)), F.col("text_hash")).alias("_gone"), F.col(key).alias("_id")).distinct())
    bits = filter_bits(gone.count())
    tested = with_hits(docs, bit_table(gone.select("_gone"), bits), bits, of_row, "_maybe")
    stay = tested.where(~F.col("_maybe")).drop("_maybe")
    same = (of_row == F.col("_gone")) & F.col(key).eqNullSafe(F.col("_id"))
    return stay.unionByName(tested.where("_maybe").drop("_maybe").join(gone, same, "left_anti"))
