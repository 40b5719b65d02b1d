"""Ranked lexical search with per-term geometric blocking.

Documents become vectors of term impacts. An index row covers up to ``SHARD`` documents of one task:
their vectors and, per term, a posting list that is cut into blocks of documents alike (the nearest of a
few of the list's own members, by a random projection of the vectors). A block stores the coordinatewise
maximum of its documents' impacts, rounded up. A search looks at an item's terms from the heaviest to the
lightest; a block of the j-th term's list is bounded by its summary over the terms from the j-th on, as
documents with an earlier term lie in an earlier list too. Only blocks whose bound is below the score of
the item's 50th document so far are skipped, so the result is that of scoring every document.

Postings are never shuffled: each task indexes the documents it reads, ``SHARD`` at a time, and gives its
best documents per item. A sixteenth of the documents is searched first; its 50th scores are where the rest
starts. ``build_index`` and ``search_index`` keep an index for later searches; ``ranked_search`` searches each
shard as soon as it is built and writes no summaries. Items are taken in blocks of at most ``MAX_TERMS`` different terms, each block over all documents,
so what is sent to tasks does not grow with either table. An item with more terms is a block of its own,
and shards are smaller then, as their arrays span the terms of the block that occur in the shard.

A document's score sums ``w * ((10**9 * tf) div (1000 * tf + 20 * m))`` over the item's different terms,
with ``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))`` and ``m = 50 + ((50 * n * N) div L)``.

Defined results: NULL and empty texts, and texts without a term, match nothing and do not count in N or L;
whole texts are read, however long; equal scores are ordered by the document's id, a NULL id last; rows that
repeat an id are ranked each; items that repeat an id or are NULL are answered each; an item without
terms, or an empty table, gives no rows. Only key and text are read, so other columns of any name do not matter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from pipewatch.llm.common import written

TOP = 50
MAX_TERMS = 4096
SHARD = 2048
BLOCK = 64
PROJECTED = 48
# A stored impact is the impact over this, rounded up: below 256, as an impact is below 10**6.
STEP = 4096

_SEPARATORS = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_FOLD = bytearray(range(256))
for _c in _SEPARATORS:
    _FOLD[_c] = 0x20
for _c in range(0x41, 0x5B):
    _FOLD[_c] = _c + 32
_FOLD = bytes(_FOLD)


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8: runs of letters, digits and all beyond ASCII, A-Z lower-cased.

    A character beyond ASCII has only bytes beyond ASCII, so runs of bytes are runs of characters.
    """
    return text.translate(_FOLD).split() if text else []


# -- vectors ----------------------------------------------------------------------

VECTORS = "doc_id long, n long, terms array<int>, tfs array<long>"


def term_vectors(docs: DataFrame, vocabulary: Sequence[bytes], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document with a term: key, number of terms, and places in ``vocabulary`` with counts."""
    place = {t: i for i, t in enumerate(vocabulary)}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))])
        for batch in batches:
            ids, ns, terms, tfs = [], [], [], []
            for key, body in zip(batch.column(0), batch.column(1)):
                words = terms_of(body.as_py())
                if not words:
                    continue
                counts = Counter(map(place.get, words))
                counts.pop(None, None)
                found = sorted(counts)
                ids.append(key.as_py())
                ns.append(len(words))
                terms.append(found)
                tfs.append([counts[t] for t in found])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((ids, ns, terms, tfs), schema)], schema=schema)

    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("body"))
    return narrow.mapInArrow(vectors, VECTORS)


def weights(documents: int, frequency: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in frequency], np.int64)


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    m = 50 + (50 * n * documents) // length
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


# -- index ------------------------------------------------------------------------

# One row per shard; arrays as little-endian bytes. Offsets have one entry more than what they cut.
_INDEX = [
    ("doc_id", np.int64), ("known", np.uint8),
    # Vectors by document.
    ("vector_offsets", np.int64), ("vector_terms", np.uint32), ("vector_impacts", np.int32),
    # Blocks by term: documents as numbers in the shard, summaries as term and rounded impact.
    ("block_terms", np.uint32), ("block_offsets", np.int64), ("block_docs", np.uint16),
    ("summary_offsets", np.int64), ("summary_terms", np.uint32), ("summary_impacts", np.uint8),
]
INDEX = ", ".join(f"{name} binary" for name, _ in _INDEX)


def blocks_of(members: np.ndarray, alike: np.ndarray) -> list[np.ndarray]:
    """A posting list cut into blocks of at most ``BLOCK`` documents that lie near one of its members."""
    if len(members) <= BLOCK:
        return [members]
    centres = members[:: BLOCK]
    nearest = (alike[members] @ alike[centres].T).argmax(axis=1)
    out = []
    for c in np.unique(nearest):
        group = members[nearest == c]
        out.extend(group[i : i + BLOCK] for i in range(0, len(group), BLOCK))
    return out


def shard_arrays(ids, ns, offsets, terms, tfs, documents: int, length: int) -> dict[str, np.ndarray]:
    """The index of one shard's documents, given as vectors end to end."""
    counts = np.diff(offsets)
    rows = np.repeat(np.arange(len(counts)), counts)
    exact = impacts(tfs, np.repeat(ns, counts), documents, length)
    present, column = np.unique(terms, return_inverse=True)
    rounded = np.zeros((len(counts), len(present)), np.uint8)
    rounded[rows, column] = -(-exact // STEP)
    projection = np.random.default_rng(7).standard_normal((len(present), PROJECTED), np.float32)
    alike = rounded.astype(np.float32) @ projection
    alike /= np.maximum(np.linalg.norm(alike, axis=1, keepdims=True), 1e-9)

    by_term = np.argsort(terms, kind="stable")
    starts = np.searchsorted(terms[by_term], present)
    out = {k: [] for k in ("docs", "terms", "sizes", "widths", "at", "max")}
    wide = present.astype(np.uint32)
    for term, members in zip(present, np.split(rows[by_term], starts[1:]) if len(present) else []):
        for block in blocks_of(members, alike):
            top = rounded[block].max(axis=0)
            at = np.flatnonzero(top)
            out["docs"].append(block.astype(np.uint16))
            out["terms"].append([term])
            out["sizes"].append([len(block)])
            out["widths"].append([len(at)])
            out["at"].append(wide[at])
            out["max"].append(top[at])
    flat = {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in out.items()}
    return {
        "doc_id": ids[0], "known": ids[1],
        "vector_offsets": offsets, "vector_terms": terms, "vector_impacts": exact,
        "block_terms": flat["terms"], "block_offsets": np.concatenate([[0], np.cumsum(flat["sizes"])]), "block_docs": flat["docs"],
        "summary_offsets": np.concatenate([[0], np.cumsum(flat["widths"])]), "summary_terms": flat["at"], "summary_impacts": flat["max"],
    }


def build_index(vectors: DataFrame, size: int, documents: int, length: int) -> DataFrame:
    """``INDEX`` rows over ``vectors``; ``size`` is the vocabulary's."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(name, pa.binary()) for name, _ in _INDEX])
        for arrays in shards_of(batches, size, documents, length):
            row = [arrays[name].astype(kind).tobytes() for name, kind in _INDEX]
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

    return vectors.mapInArrow(index, INDEX)


def shards_of(batches: Iterator[pa.RecordBatch], size: int, documents: int, length: int) -> Iterator[dict[str, np.ndarray]]:
    """The arrays of each shard of a task's vectors."""
    for table in _shards(batches, max(1, min(SHARD, SHARD * MAX_TERMS // max(size, 1)))):
        ids, terms, tfs = table["doc_id"].combine_chunks(), table["terms"].combine_chunks(), table["tfs"].combine_chunks()
        offsets = terms.offsets.to_numpy().astype(np.int64)
        yield shard_arrays(
            (ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False)),
            table["n"].to_numpy(),
            offsets - offsets[0],
            terms.flatten().to_numpy().astype(np.int64),
            tfs.flatten().to_numpy(),
            documents,
            length,
        )


def _shards(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The batches of a task, dealt out anew in tables of ``rows`` rows."""
    held, count = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - count)
            batch = batch.slice(part.num_rows)
            held.append(part)
            count += part.num_rows
            if count == rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, count = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


# -- search -----------------------------------------------------------------------


class Best:
    """The ``TOP`` highest-scoring documents of one item so far."""

    def __init__(self, floor: int, top: int):
        self.floor, self.top = floor, top
        self.score, self.unknown, self.doc = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, score: np.ndarray, unknown: np.ndarray, doc: np.ndarray) -> None:
        fit = score >= max(self.floor, 1)
        merged = [np.concatenate([a, b[fit]]) for a, b in ((self.score, score), (self.unknown, unknown), (self.doc, doc))]
        first = np.lexsort((merged[2], merged[1], -merged[0]))[: self.top]
        self.score, self.unknown, self.doc = (a[first] for a in merged)
        if len(first) == self.top:
            self.floor = max(self.floor, int(self.score[-1]))


def search_shard(arrays: dict[str, np.ndarray], size: int, items: Sequence[np.ndarray], weight: np.ndarray, best: Sequence[Best]) -> int:
    """Offers a shard's documents to every item's ``best``; returns how many scores were computed."""
    documents = len(arrays["doc_id"])
    present = np.unique(arrays["vector_terms"])
    column = np.full(size, -1)
    column[present] = np.arange(len(present))
    exact = np.zeros((documents, len(present)), np.int32)
    exact[np.repeat(np.arange(documents), np.diff(arrays["vector_offsets"])), column[arrays["vector_terms"]]] = arrays["vector_impacts"]
    blocks = len(arrays["block_terms"])
    summary = np.zeros((blocks, len(present)), np.uint8)
    summary[np.repeat(np.arange(blocks), np.diff(arrays["summary_offsets"])), column[arrays["summary_terms"]]] = arrays["summary_impacts"]
    lists = np.searchsorted(column[arrays["block_terms"]], np.arange(len(present) + 1))
    heavy = weight[present]
    bounds_of, members, unknown = arrays["block_offsets"], arrays["block_docs"], 1 - arrays["known"].astype(np.int64)
    scored = 0
    for terms, top in zip((c[c >= 0] for c in (column[i] for i in items)), best):
        if not len(terms):
            continue
        w = heavy[terms]
        number = lists[terms + 1] - lists[terms]
        order = np.repeat(np.arange(len(terms)), number)
        chosen = np.concatenate([np.arange(lists[t], lists[t + 1]) for t in terms])
        tails = (summary[np.ix_(chosen, terms)].astype(np.int64) * w)[:, ::-1].cumsum(axis=1)[:, ::-1]
        bound = tails[np.arange(len(chosen)), order] * STEP
        ranked = np.argsort(-bound, kind="stable")
        chosen, bound = chosen[ranked], bound[ranked]
        seen = np.zeros(documents, bool)
        start, width = 0, 2
        while start < len(chosen):
            # Bounds fall, so the first that fails ends the item; a bound equal to the floor may still tie.
            stop = min(start + width, int(np.searchsorted(-bound, -max(top.floor, 1), side="right")))
            if stop <= start:
                break
            docs = np.concatenate([members[bounds_of[b] : bounds_of[b + 1]] for b in chosen[start:stop]])
            docs = np.unique(docs[~seen[docs]])
            seen[docs] = True
            top.add(exact[np.ix_(docs, terms)] @ w, unknown[docs], arrays["doc_id"][docs])
            scored += len(docs)
            start, width = stop, width * 4
    return scored


FOUND = "item int, doc_id long, score long"


def _search(shards: Iterator[dict], size: int, items: Sequence[np.ndarray], weight: np.ndarray, floors: Sequence[int], top: int):
    """The best documents of a task's shards per item, with a score of at least the item's floor."""
    # The heaviest terms first: documents that hold them leave the long lists of the light ones.
    ordered = [i[np.argsort(-weight[i], kind="stable")] for i in (i[weight[i] > 0] for i in items)]
    best = [Best(f, top) for f in floors]
    for arrays in shards:
        search_shard(arrays, size, ordered, weight, best)
    item = np.repeat(np.arange(len(best)), [len(b.doc) for b in best])
    if len(item):
        doc, unknown, score = (np.concatenate([getattr(b, a) for b in best]) for a in ("doc", "unknown", "score"))
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array(doc, pa.int64(), mask=unknown > 0), pa.array(score, pa.int64())],
            names=["item", "doc_id", "score"],
        )


def search_index(index: DataFrame, size: int, items: Sequence[np.ndarray], weight: np.ndarray, floors: Sequence[int], top: int) -> DataFrame:
    """``item`` (its number), ``doc_id``, ``score`` from a kept index; ``best_of`` joins the tasks' answers."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = (
            {name: np.frombuffer(batch.column(name)[i].as_buffer(), kind) for name, kind in _INDEX} for batch in batches for i in range(batch.num_rows)
        )
        yield from _search(shards, size, items, weight, floors, top)

    return index.mapInArrow(search, FOUND)


def search_vectors(
    vectors: DataFrame, size: int, documents: int, length: int, items: Sequence[np.ndarray], weight: np.ndarray, floors: Sequence[int], top: int
) -> DataFrame:
    """As ``search_index``, but each shard's index lives only while it is searched."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _search(shards_of(batches, size, documents, length), size, items, weight, floors, top)

    return vectors.mapInArrow(search, FOUND)


def best_of(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _item_blocks(items: Iterator, max_terms: int) -> Iterator[list[tuple]]:
    """Items as (id, terms) in blocks of at most ``max_terms`` different terms."""
    held, seen = [], set()
    for row in items:
        words = sorted(set(terms_of(bytes(row[1]) if row[1] is not None else None)))
        if held and len(seen.union(words)) > max_terms:
            yield held
            held, seen = [], set()
        seen.update(words)
        held.append((row[0], words))
    if held:
        yield held


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    max_terms: int = MAX_TERMS,
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: each item's ``top`` best documents with a score above 0."""
    spark = docs.sparkSession
    wanted = items.select(F.col(item_key).alias("item_id"), F.col(item_text).cast("binary").alias("body"))
    id_type = wanted.schema["item_id"].dataType.simpleString()
    answers = spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id long, score long")
    for block in _item_blocks(wanted.toLocalIterator(), max_terms):
        vocabulary = sorted({t for _, words in block for t in words})
        found = _search_block(docs, block, vocabulary, key, text, top)
        if found is not None:
            names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(block)], f"item int, item_id {id_type}")
            # As many rows as the block has items.
            answers = answers.unionByName(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return answers


def _search_block(docs: DataFrame, block: list[tuple], vocabulary: list[bytes], key: str, text: str, top: int) -> DataFrame | None:
    size = len(vocabulary)
    if not size:
        return None
    vectors = written(term_vectors(docs, vocabulary, key, text), "vectors")
    documents, length = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not documents:
        return None
    frequency = np.zeros(size, np.int64)
    # One row per term of the block.
    for term, n in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        frequency[term] = n
    weight = weights(documents, frequency)
    place = {t: i for i, t in enumerate(vocabulary)}
    numbered = [np.array([place[t] for t in words], np.int64) for _, words in block]
    held = vectors.where(F.size("terms") > 0)
    early = F.pmod(F.xxhash64("doc_id"), F.lit(16)) == 0

    def search(part: DataFrame, floors: list[int]) -> DataFrame:
        return search_vectors(part, size, documents, length, numbered, weight, floors, top)

    first = written(best_of(search(held.where(early), [1] * len(block)), top), "early")
    floors = [1] * len(block)
    # One row per item of the block.
    for item, floor in first.where(F.col("rank") == top).select("item", "score").collect():
        floors[item] = floor
    return best_of(search(held.where(~early), floors).unionByName(first.drop("rank")), top)
