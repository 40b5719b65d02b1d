"""BPE and packing: equal to the library, and round trips."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pipewatch.llm import bpe, packing
from pipewatch.llm.queries import vocabulary

tokenizers = pytest.importorskip("tokenizers")
TEXTS = [
    None,
    "",
    " ",
    "Hello world, it's  fine\n\n  ok\t\tand we'll see",
    "naïve café ÉÀ ßtraße Ωσς ÎLE İstanbul",
    "control <|endoftext|> inside<|endoftext|><|startoftext|> x <|endof",
    "日本語のテキスト 한국어 🙂👩‍👩‍👧 ȩ́   x\x1cy\x85z",
    "a" * 5000 + " " + "ab" * 3000 + "1234567890" * 50,
    "   leading   and trailing   ",
    "'s 't 've don't CAN'T 'S x's",
    "".join(chr(c) for c in range(1, 0x250)),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "twice", "x"), (None, "twice", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string")


def test_bpe_equals_library(spark, docs):
    path = vocabulary("byte_bpe_50k.json")
    own = tokenizers.Tokenizer.from_file(path)
    got = docs.select("text", bpe.bpe_encode(F.col("text"), path).alias("ids"))
    got = got.select("text", "ids", bpe.bpe_decode(F.col("ids"), path).alias("back")).collect()
    assert len(got) == len(TEXTS) + 2
    for row in got:
        want = own.encode(row.text or "", add_special_tokens=False).ids
        assert np.frombuffer(row.ids, "<u4").tolist() == want
        assert row.back == own.decode(want, skip_special_tokens=False)


def test_slices_do_not_change_ids(monkeypatch):
    path = vocabulary("byte_bpe_50k.json")
    whole = bpe.SpeculativeBpe(path).encode(TEXTS[3:])
    monkeypatch.setattr(bpe, "SLICE", 7)
    assert bpe.SpeculativeBpe(path).encode(TEXTS[3:]) == whole


def test_failing_words_need_merging():
    """The greedy guess alone is wrong for some words, and the check finds just these."""
    path = vocabulary("byte_bpe_50k.json")
    own, lib = bpe.SpeculativeBpe(path), tokenizers.Tokenizer.from_file(path)
    words = [w.encode() for w in "theoreticians athat herenth ndoring unhappiness stthere wherein".split()]
    wrong = [own.greedy(w) != lib.encode(w.decode()).ids for w in words]
    assert any(wrong) and not all(wrong)
    assert own.encode_words(words) == [lib.encode(w.decode()).ids for w in words] == [own.merged(w) for w in words]


def test_pieces_equal_library(spark, docs):
    path = vocabulary("word_bpe_49k.json")
    own = tokenizers.Tokenizer.from_file(path)
    pieces = packing.token_pieces(docs, path, length=64, with_ids=True).collect()
    for i, text in enumerate(TEXTS):
        mine = sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.piece)
        ids = own.encode(text or "", add_special_tokens=False).ids + [1]
        assert [x for p in mine for x in np.frombuffer(p.ids, "<u4").tolist()] == ids
        assert [p.start for p in mine] == [64 * j for j in range(len(mine))]
        assert all(p.length == 64 for p in mine[:-1])
        assert all(zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length for p in mine)


def check_packing(rows, length):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= length
    return len(by)


@pytest.mark.parametrize("per_task", [7, 50_000])
def test_packing_is_whole_and_tight(spark, monkeypatch, per_task):
    monkeypatch.setattr(packing, "ITEMS_PER_TASK", per_task)
    pieces = spark.range(0, 600, 1, 6).select(
        "id", F.lit(0).alias("piece"), (F.pmod(F.xxhash64("id"), F.lit(100)) + 1).cast("int").alias("length")
    )
    rows = packing.pack_pieces(pieces, 100).collect()
    assert sorted((r.id, r.length) for r in rows) == sorted((r.id, r.length) for r in pieces.collect())
    bins, least = check_packing(rows, 100), -(-sum(r.length for r in rows) // 100)
    assert bins <= least * 1.12


def test_packing_edge_cases(spark, docs):
    path = vocabulary("word_bpe_49k.json")
    assert packing.pack_documents(docs.limit(0), path).count() == 0
    rows = packing.pack_documents(docs.withColumn("offset", F.lit("clash")), path, length=64).collect()
    check_packing(rows, 64)
    assert sum(r.doc_id is None for r in rows) == 2
    ones = spark.range(300).select("id", F.lit(1).alias("length"))
    # Each of the four partitions leaves a bin of 75, and bins are not taken apart again.
    assert check_packing(packing.pack_pieces(ones, 100).collect(), 100) == 4


def test_sequences_hold_the_ids(spark):
    path = vocabulary("word_bpe_49k.json")
    docs = spark.createDataFrame([(i, "one two three " * i) for i in range(30)], "doc_id long, text string")
    pieces = packing.token_pieces(docs, path, length=64, with_ids=True)
    placed = packing.pack_pieces(pieces.drop("ids"), 64).cache()
    ids = {r.sequence_id: r.ids for r in packing.sequences(pieces, placed).collect()}
    assert sum(map(len, ids.values())) == 4 * placed.agg(F.sum("length")).first()[0]
    for r in placed.collect():
        assert zlib.crc32(ids[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)]) == r.ids_crc32


def test_one_pass_equals_two_and_memory_of_words_is_bounded(spark, docs, monkeypatch):
    path = vocabulary("byte_bpe_50k.json")
    both = docs.select("text", bpe.bpe_round_trip(F.col("text"), path).alias("both"), bpe.bpe_encode(F.col("text"), path).alias("one"))
    for row in both.collect():
        assert (row.both.ids, row.both.decoded) == (row.one, row.text or "")
    assert docs.limit(0).select(bpe.bpe_round_trip(F.col("text"), path)).count() == 0
    whole = bpe.SpeculativeBpe(path)
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    small = bpe.SpeculativeBpe(path)
    for text in TEXTS[3:] * 2:
        assert small.encode([text]) == whole.encode([text])
        assert set(text.split()) or small.known is not None
    assert len(small.older) < len(whole.known)


def test_short_and_long_words_merge_alike(monkeypatch):
    path = vocabulary("byte_bpe_50k.json")
    own = bpe.SpeculativeBpe(path)
    words = [w.encode() for t in TEXTS[3:] for w in own.words.findall(t)]
    short = [own.merged(w) for w in words]
    monkeypatch.setattr(bpe, "SHORT", 0)
    assert [own.merged(w) for w in words] == short
