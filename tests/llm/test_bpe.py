"""Merge replay against the tiktoken library, and exact round trips."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, chunks
from ledgerloom.llm.queries import op10_byte_bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def both():
    ranks = bpe.load_ranks(PATH)
    theirs = tiktoken.Encoding("test", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return bpe.ByteBpe(PATH, PATTERN), theirs


def odd_texts():
    draw = random.Random(3)
    made = ["".join(draw.choice("ab \n\t's=1é　あ-!\x1c\x00") for _ in range(draw.randint(0, 90))) for _ in range(400)]
    return [
        "", " ", "\n\n", "  a  b\n\n c", "a\x1c b", "\x00x y", "aaaa" * 300 + " b", "!!!!????\n" * 40, " lead", "trail ",
        "\t\tx y   z", "日本語 テスト 한국어 🎉🎉 ñandú", "'s't don't I'LL", "<|endoftext|>", "=" * 5000, *made,
    ]


def test_same_ids_as_the_library(both):
    ours, theirs = both
    texts = odd_texts()
    for text, ids in zip(texts, ours.table.texts(texts), strict=True):
        assert ids.tolist() == theirs.encode_ordinary(text), text[:50]
        assert ours.decode(ids) == text.encode("utf-8")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8"), max_size=60), max_size=5))
def test_any_text(texts):
    ours = bpe.loaded(PATH, PATTERN)
    for text, ids in zip(texts, ours.table.texts(texts), strict=True):
        assert ours.decode(ids) == text.encode("utf-8")


def test_ranks_below_the_current_one_come_first():
    # merging (b, c) opens a pair of lower rank, which must come before later places
    singles = {bytes([i]): i + 10 for i in range(256)}
    ranks = singles | {b"bc": 500, b"abc": 400, b"cb": 600}
    reference = tiktoken.Encoding("t", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    replay = bpe.MergeReplay(ranks)
    for word in (b"abcbc", b"abcabcbcb", b"bcbcbc", b"cbcb", b"a"):
        ids, _ = replay.encode([word])
        assert ids.tolist() == reference.encode_ordinary(word.decode())


def test_small_table_starts_afresh():
    table = bpe.ByteBpe(PATH, PATTERN).table
    table.keep = 3
    texts = ["one two three four", "five six seven", "one five"]
    kept = bpe.loaded(PATH, PATTERN).table.texts(texts)
    for text, ids in zip(texts, kept, strict=True):
        assert table.texts([text])[0].tolist() == ids.tolist()


def test_frame_with_nulls_clashing_names_and_no_rows(rows):
    df = rows("doc_id long, text string, ids string, decoded int", [(1, None, "x", 1), (2, "", None, None), (2, "a b", "y", 2), (None, "a b", "y", 2)])
    out = bpe.decode(bpe.encode(df, PATH, PATTERN), PATH, PATTERN)
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    got = {(r.doc_id, r.text): (bytes(r.ids), bytes(r.decoded)) for r in out.collect()}
    at_once = bpe.encode(df, PATH, PATTERN, decoded="decoded")
    assert got == {(r.doc_id, r.text): (bytes(r.ids), bytes(r.decoded)) for r in at_once.collect()}
    assert got[1, None] == got[2, ""] == (b"", b"")
    assert got[2, "a b"] == got[None, "a b"] and got[2, "a b"][1] == b"a b"
    assert bpe.encode(df.limit(0), PATH, PATTERN).count() == 0


def test_documents_take_all_ids_from_the_chunk_tables(spark, both):
    draw = random.Random(5)
    texts = [" ".join(draw.choice(["the", "cats", "Straße", "ünü!", "x" * 150]) for _ in range(draw.randint(0, 60))) for _ in range(90)]
    texts += [*odd_texts(), "y" * 3000 + " the " + "z" * 500]
    df = spark.createDataFrame([(x,) for x in texts], "text string").repartition(3).persist()
    root = bpe.write_chunk_table(df, PATH, PATTERN, "text", size=400)
    ours, theirs = both
    seen = 0
    for part, own in enumerate(df.rdd.glom().collect()):
        tables, groups = bpe.GroupTables(root, part, both[0].width), bpe.Groups(400)
        own, now, replayed = [r.text for r in own], -1, []
        table = chunks.ChunkTable(lambda keys: replayed.extend(keys) or ours.encode_chunks(keys), chunks.split_keeping_space)
        for group, a, b in groups.ranges(own):
            if group != now:
                keys, ids, lengths = tables.of(group)
                assert len(set(keys)) == len(keys) == len(lengths) and lengths.sum() == len(ids)
                table.fill(keys, ids, lengths)
                now, seen = group, seen + 1
            for text, ids in zip(own[a:b], table.texts(own[a:b]), strict=True):
                assert ids.tolist() == theirs.encode_ordinary(text)
        assert all(len(k) > bpe.LONG_CHUNK for k in replayed)
    assert seen > 20
    df.unpersist()


def test_packed_chunks_keep_their_order(spark, both):
    keys = [*(f" w{k}" for k in range(300)), "\0" + "ab" * 90, "\nnew", "\0 \0é"]
    texts = [bpe.chunks.raw_chunk(k) for k in keys]
    sizes = np.array([len(k.encode()) for k in keys])
    blob = bpe.packed(sizes, "".join(keys).encode())
    assert bpe.unpacked_chunks(blob) == keys
    assert bpe.unpacked_chunks(bpe.packed(sizes[:0], b"")) == []
    rows = [(part, group, 1, bytearray(blob)) for part in range(3) for group in range(4)]
    got = bpe.with_ids(spark.createDataFrame(rows, "part int, group int, bucket int, chunks binary"), PATH, PATTERN).collect()
    assert sorted((r.part, r.group, 1, r.chunks) for r in got) == sorted(rows)
    for r in got:
        lengths, data = bpe.unpacked(r.ids)
        ids = np.split(np.frombuffer(data, both[0].width), np.cumsum(lengths)[:-1])
        assert [x.tolist() for x in ids] == [both[1].encode_ordinary(t) for t in texts]


def test_rows_dealt_otherwise_on_the_second_reading(spark, both):
    texts = [f"the text number {i} of\n{i % 7} cats" for i in range(50)]
    df = spark.createDataFrame([(x,) for x in texts], "text string")
    nothing = bpe.write_chunk_table(df.limit(0), PATH, PATTERN, "text")
    assert bpe.GroupTables(nothing, 3, "<u2").of(0)[0] == []
    for r in bpe.encode(df.orderBy(F.rand()).repartition(4), PATH, PATTERN).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == both[1].encode_ordinary(r.text)


def test_query(spark, both):
    import hashlib

    got = {r.doc_id: r for r in op10_byte_bpe(spark, "/root/testdata/sf0.001").collect()}
    for doc_id, text in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect():
        ids = both[1].encode_ordinary(text)
        assert got[doc_id].n_tokens == len(ids)
        assert got[doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
