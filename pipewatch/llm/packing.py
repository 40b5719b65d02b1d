"""Packing documents into fixed-length token sequences by hierarchical best fit.

Each partition packs its own pieces best-fit decreasing and emits the bins that are nearly full
or that nothing left could enter. The underfull bins become items of the next round, in which
several partitions are merged into one, until one task holds the rest or a round no longer helps.
Only residual bins move between tasks; a bin carries its members, at most one per token.

Defined results: NULL text counts as empty, which is one closing id; only documents beyond the
length are cut, into full pieces and a rest; documents and ids that repeat are packed each for
itself; an empty table gives an empty one; columns other than key and text are not read.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from pipewatch.llm.common import written

LENGTH = 4096
CLOSING_ID = 1
# Free tokens up to which a bin is emitted at once.
SLACK = 8
# Items that are packed together.
ITEMS_PER_TASK = 50_000
REMEMBERED = 600_000
SLICE = 1 << 22

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


class ChunkIds:
    """Ids of texts by the ``tokenizers`` library, which is asked once per distinct chunk.

    No word of such a tokenizer crosses white space, so ids of chunks simply follow one another.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.known: dict[bytes, bytes] = {}
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        lowered = [s["type"] for s in (spec.get("normalizer") or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        split = [s["pattern"]["Regex"] for s in steps if s["type"] == "Split" and s["behavior"] == "Removed" and s["invert"]]
        # The short way below is only for chunks whose characters all precede the first combining
        # mark: composing leaves them alone and lower-casing works letter by letter.
        self.words = regex.compile(split[0]) if lowered and len(split) == 1 and len(steps) == 2 else None
        self.added = [t["content"].encode() for t in spec.get("added_tokens", [])]
        from pipewatch.llm.bpe import byte_alphabet

        self.alphabet = dict(enumerate(byte_alphabet()))

    def _ids(self, chunk: bytes) -> list[int]:
        text = chunk.decode()
        if self.words is None or (not text.isascii() and max(text) >= "ɐ") or any(a in chunk for a in self.added):
            return self.whole.encode(text, add_special_tokens=False).ids
        tokenize, out = self.whole.model.tokenize, []
        for word in self.words.findall(text.lower()):
            spelled = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self.alphabet)
            out += [t.id for t in tokenize(spelled)]
        return out

    def encode(self, text: bytes) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        known, out = self.known, []
        for part in _slices(text):
            if len(known) > REMEMBERED:
                known.clear()
            chunks = part.split()
            try:
                out.append(b"".join([known[c] for c in chunks]))
            except KeyError:
                for c in {c for c in chunks if c not in known}:
                    known[c] = np.array(self._ids(c), "<u4").tobytes()
                out.append(b"".join([known[c] for c in chunks]))
        return b"".join(out)


def _slices(text: bytes) -> Iterator[bytes]:
    """Parts of about ``SLICE`` bytes, cut at white space; a longer chunk stays whole."""
    start = 0
    while len(text) - start > SLICE and (cut := _SPACE.search(text, start + SLICE)):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


@lru_cache(maxsize=2)
def _loaded(path: str) -> ChunkIds:
    return ChunkIds(path)


# -- pieces -------------------------------------------------------------------

PIECE = "`{key}` {kind}, piece int, start bigint, length int, ids_crc32 bigint"


def token_pieces(
    docs: DataFrame,
    path: str,
    length: int = LENGTH,
    closing_id: int = CLOSING_ID,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: key, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if wanted, ``ids``."""
    narrow = docs.select(F.col(key), F.col(text))
    schema = PIECE.format(key=key, kind=narrow.schema[0].dataType.simpleString()) + (", ids binary" if with_ids else "")
    closing = np.array([closing_id], "<u4").tobytes()
    width = 4 * length

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _loaded(path).encode
        for batch in batches:
            row, piece, count, crc, ids = [], [], [], [], []
            for i, raw in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                whole = encode(raw or b"") + closing
                for j in range(0, len(whole), width):
                    part = whole[j : j + width]
                    row.append(i)
                    piece.append(j // width)
                    count.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
            numbers = np.array(piece, np.int32)
            columns = [
                batch.column(0).take(pa.array(row, pa.int32())),
                pa.array(numbers),
                pa.array(numbers.astype(np.int64) * length),
                pa.array(count, pa.int32()),
                pa.array(crc, pa.int64()),
            ]
            names = [key, "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return narrow.mapInArrow(cut, schema)


# -- best fit -----------------------------------------------------------------


def best_fit(loads: np.ndarray, length: int) -> list[list[int]]:
    """Best-fit decreasing: positions of the items of each bin, in the order they went in.

    Open bins lie in lists by free tokens; a bit mask of the lists in use gives the tightest fit
    in one step.
    """
    free: list[list[int]] = [[] for _ in range(length + 1)]
    mask, bins = 0, []
    for item in np.argsort(-loads, kind="stable").tolist():
        load = int(loads[item])
        fits = mask >> load
        if fits:
            room = load + (fits & -fits).bit_length() - 1
            own = free[room].pop()
            if not free[room]:
                mask &= ~(1 << room)
            bins[own].append(item)
            room -= load
        else:
            own, room = len(bins), length - load
            bins.append([item])
        free[room].append(own)
        mask |= 1 << room
    return bins


def _pack_round(items: DataFrame, length: int) -> DataFrame:
    """Bins of the items of each partition, ``ITEMS_PER_TASK`` at a time: ``load``, ``members``, ``done``.

    Members keep the order in which they went in, and their ``offset`` in the bin.
    """
    schema = T.StructType(
        [T.StructField("load", T.IntegerType()), T.StructField("done", T.BooleanType()), items.schema["members"]]
    )

    def bins_of(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        loads = batch.column(0).to_numpy().astype(np.int64)
        bins = best_fit(loads, length)
        sums = np.array([loads[b].sum() for b in bins])
        taken = batch.column(1).take(pa.array(np.concatenate(bins)))
        # Where the members of each bin begin among all members, and which item each belongs to.
        starts = np.concatenate([[0], np.cumsum(taken.value_lengths().to_numpy())])
        starts = starts[np.cumsum([0, *map(len, bins)])]
        members = taken.flatten()
        lengths = members.field("length").to_numpy().astype(np.int64)
        ahead = np.cumsum(lengths) - lengths
        offsets = ahead - np.repeat(ahead[starts[:-1]], np.diff(starts))
        fields = [members.field(f.name) if f.name != "offset" else pa.array(offsets) for f in members.type]
        again = pa.StructArray.from_arrays(fields, fields=list(members.type))
        packed = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), again, type=batch.column(1).type)
        columns = [pa.array(sums, pa.int32()), pa.array(sums >= length - SLACK), packed]
        yield from pa.Table.from_arrays(columns, ["load", "done", "members"]).to_batches(max_chunksize=5_000)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held += [batch] if len(batch) else []
            if sum(map(len, held)) >= ITEMS_PER_TASK:
                yield from bins_of(held)
                held = []
        if held:
            yield from bins_of(held)

    return items.select("load", "members").mapInArrow(pack, schema)


def pack_pieces(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """``pieces`` (any columns with sortable names; ``length`` is one) plus ``sequence_id`` and ``offset``.

    Pieces of full length are sequences of their own. The others are packed where they lie. Each
    further round gathers the underfull bins into as few tasks as may hold them, until one task
    holds them all, or until a round closes under a tenth of them and the rest is as good as it gets.
    """
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    members = F.array(F.struct(*names, F.lit(0).cast("long").alias("offset"))).alias("members")
    items = pieces.select(F.col("length").alias("load"), members)
    closed = [items.where(F.col("load") >= length).select("load", F.lit(True).alias("done"), "members")]
    rest, tasks, before = items.where(F.col("load") < length), 0, math.inf
    while True:
        packed = written(_pack_round(rest, length), "packing-round")
        closed.append(packed.where("done"))
        rest = packed.where(~F.col("done"))
        left, smallest = rest.agg(F.count(F.lit(1)), F.min("load")).first()
        if not left or tasks == 1 or left > 0.9 * before:
            break
        # Into these not even the smallest item that is left fits.
        closed.append(rest.where(F.col("load") > length - smallest))
        rest = rest.where(F.col("load") <= length - smallest)
        tasks, before = -(-left // ITEMS_PER_TASK), left
        rest = rest.repartition(tasks)
    for more in closed:
        rest = rest.unionByName(more)
    numbered = rest.select(F.monotonically_increasing_id().alias("sequence_id"), "members")
    numbered = numbered.select("sequence_id", F.explode("members").alias("m"))
    return numbered.select(*[F.col(f"m.`{c}`").alias(c) for c in names], "sequence_id", F.col("m.offset").alias("offset"))


def pack_documents(
    docs: DataFrame,
    path: str,
    length: int = LENGTH,
    closing_id: int = CLOSING_ID,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Where each piece of each document lies: the pieces plus ``sequence_id`` and ``offset``."""
    pieces = written(token_pieces(docs, path, length, closing_id, key, text), "token-pieces")
    return pack_pieces(pieces, length)


def sequences(pieces: DataFrame, placed: DataFrame, key: str = "doc_id") -> DataFrame:
    """The packed ids themselves, one row per sequence, of unique keys: at most ``length`` ids each."""
    joined = pieces.select(key, "piece", "ids").join(placed.select(key, "piece", "sequence_id", "offset"), [key, "piece"])
    grouped = joined.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return grouped.select("sequence_id", F.aggregate("p", F.lit(b"").cast("binary"), lambda s, x: F.concat(s, x["ids"])).alias("ids"))
