"""Id files against the tokenizers library; the coding on its own."""

import unicodedata
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerloom.llm import token_files
from ledgerloom.llm.queries import op2_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=50))
def test_coding_round_trip(values):
    control, data = token_files.encode_block(np.array(values, np.uint32))
    assert len(control) == -(-len(values) // 4)
    assert len(data) == sum(1 + (v > 0xFF) + (v > 0xFFFF) + (v > 0xFFFFFF) for v in values)
    assert token_files.decode_block(control, data, len(values)).tolist() == values


def test_chunks_as_the_library(spark):
    library = Tokenizer.from_file(PATH)
    texts = ["", "Don't STOP!! the x1y2", "É é éa ǅ ß ﬁ İstanbul ΑΣ ας.", "a\tb\x0bc d\x1ce", "<|endoftext|> x<|endoftext|>y", "!!! 123 4五 ...", "é ́x e ́"]
    ours = token_files.loaded(PATH, True)
    for text, ids in zip(texts, ours.table.texts(texts), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_letters_whose_normal_form_ends_in_a_mark(spark):
    """Every such letter, alone and after a word, before each ASCII mark."""
    library, ours = Tokenizer.from_file(PATH), token_files.loaded(PATH, True)
    forms = ((chr(i), unicodedata.normalize("NFC", chr(i)).lower()) for i in range(0x110000) if not 0xD800 <= i < 0xE000)
    letters = [c for c, form in forms if c.isalpha() and not form.isalpha()]
    assert len(letters) > 50 and "\u0130" in letters
    texts = ["Zİ|", "AYDINİ.", "क़!", "שׁ,", *(f"{c}{mark} x{c}{mark}" for c in letters for mark in token_files.MARKS)]
    for text, ids in zip(texts, ours.table.texts(texts), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_any_letter_before_a_mark(spark):
    library, ours = Tokenizer.from_file(PATH), token_files.loaded(PATH, True)
    texts = [chr(i) + "!" for i in range(0x110000) if not 0xD800 <= i < 0xE000 and chr(i).isalpha()]
    want = library.encode_batch_fast(texts, add_special_tokens=False)
    assert [ids.tolist() for ids in ours.table.texts(texts)] == [w.ids for w in want]


def test_files_in_key_order_with_nulls_ties_and_clashes(spark, rows, scratch):
    data = [(5, "b c", 1), (5, "a", 1), (None, "n", 2), (1, None, 3), (-3, "", 4), (9, "x " * 3000, 5), (5, "a", 1)]
    df = rows("doc_id long, text string, ids int", data)
    files = token_files.write(df, scratch("ids"), PATH, end_id=2)
    got = token_files.read(spark, files).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, -3, 1, 5, 5, 5, 9]
    library = Tokenizer.from_file(PATH)
    ordered = ["n", "", "", "a", "a", "b c", "x " * 3000]
    start = 0
    for row, text in zip(got, ordered, strict=True):
        want = library.encode(text, add_special_tokens=False).ids + [2]
        assert np.frombuffer(row.ids, "<u4").tolist() == want and row.start == start
        start += len(want)
    counts = [0] * 49408
    for row in got:
        for i in np.frombuffer(row.ids, "<u4"):
            counts[i] += 1
    ranked = np.frombuffer(files.by_rank, "<u4").tolist()
    assert ranked == sorted((i for i, n in enumerate(counts) if n), key=lambda i: (-counts[i], i))


def test_no_documents(spark, rows, scratch):
    files = token_files.write(rows("doc_id long, text string", []), scratch("ids"), PATH, end_id=2)
    assert files.files == [] and token_files.read(spark, files).count() == 0


def test_query(spark):
    library = Tokenizer.from_file(PATH)
    got = {r.doc_id: r for r in op2_token_files(spark, "/root/testdata/sf0.001").collect()}
    start = 0
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    for doc in docs:
        ids = library.encode(doc.text, add_special_tokens=False).ids + [2]
        row = got[doc.doc_id]
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(got) == len(docs)
