"""Operator 2: token ids in binary files, as frequency ranks in byte-aligned variable-length coding.

1. Documents are dealt by ranges of ``doc_id``; each task tokenises its range
   into a raw id file and reports how often each id occurs.
2. Ids are ranked by their corpus frequency (a table of the vocabulary's size).
3. Each raw file becomes an id file: a document table, then the ranks with one
   control byte for four ids (two bits: 1 to 4 data bytes) apart from the data
   bytes.
4. Reading decodes with numpy: a table of 256 entries gives the four lengths
   behind a control byte.

All files are under the shared folder, written whole or not at all.
"""

from __future__ import annotations

import json
import operator
import struct
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import chunks
from ledgerloom.llm.common import (
    prepare,
    read_bytes,
    shuffle_partitions,
    slices,
    staged,
    strings,
    write_atomically,
)

MAGIC = b"LLIDS001"
# ids coded in one block of a file, so that reader and writer work in bounded memory
BLOCK_IDS = 1 << 22

# pieces and chunks kept between batches (memory only)
KEPT_PIECES, KEPT_CHUNKS = 400_000, 250_000
# characters of one step: its chunks are the work space beside the tables
SLICE = 1_500_000
# pieces encoded in one call
GROUP = 500
# ASCII marks without the apostrophe (which opens pieces of its own)
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

# lengths of the four values behind each control byte
LENGTHS = np.array([[(c >> (2 * k) & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)


def encode_block(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    values = np.asarray(values, np.uint32)
    lengths = 1 + (values > 0xFF).astype(np.int64) + (values > 0xFFFF) + (values > 0xFFFFFF)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = lengths - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    little = values.astype("<u4").view(np.uint8).reshape(-1, 4)
    data = little[np.arange(4) < lengths[:, None]]
    return control.tobytes(), data.tobytes()


def decode_block(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of ``encode_block``, by table lookup of the lengths."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    stored = np.frombuffer(data, np.uint8)
    wide = np.zeros((n, 4), np.uint8)
    wide[np.arange(4) < lengths[:, None]] = stored
    return wide.view("<u4").reshape(-1)


class Tokens:
    """A tokenizers-library file with the worker's table of distinct chunks.

    A chunk of letters, or of letters and then ASCII marks, is cut into these two
    pieces, as the word-end tokenizers cut it; pieces not seen before are encoded
    together, joined by blanks.  One token of each piece closes a word, so as many
    closing tokens as pieces means that each piece has its own; where they differ,
    and for every other chunk, the library encodes the chunk by itself.
    """

    def __init__(self, path: str, special: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        self.lowers = any(x["type"] == "Lowercase" for x in _flat(json.loads(self.tokenizer.to_str())["normalizer"]))
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.closes = np.zeros(self.size, bool)
        if suffix:
            self.closes[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.table = chunks.ChunkTable(self._encode, chunks.split_dropping_space, keep=KEPT_CHUNKS)
        self.pieces: dict[str, bytes] = {"": b""}

    def _alone(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _fill(self, pieces: list[str]) -> None:
        groups = [pieces[a : a + GROUP] for a in range(0, len(pieces), GROUP)]
        joined = self._alone([" ".join(g) for g in groups])
        for group, raw in zip(groups, joined, strict=True):
            ends = (np.flatnonzero(self.closes[np.frombuffer(raw, "<u4")]) + 1) * 4
            if len(ends) == len(group) and ends[-1] == len(raw):
                cuts = [0, *ends.tolist()]
                self.pieces.update((x, raw[cuts[i] : cuts[i + 1]]) for i, x in enumerate(group))
            else:
                self.pieces.update(zip(group, self._alone(group), strict=True))

    def _encode(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.pieces) > KEPT_PIECES:
            self.pieces = {"": b""}
        cores, tails, other = [], [], []
        for key in keys:
            core = key.rstrip(MARKS)
            tail = key[len(core) :]
            if core.isascii():
                if self.lowers:  # the tokenizer lower-cases: one piece for both cases
                    core = core.lower()
                whole = core.isalpha() or not core
            else:
                whole = _only_letters(core)
            if not whole:  # neither letters nor marks alone, so no piece has this key
                core, tail = key, ""
                other.append(key)
            cores.append(core)
            tails.append(tail)
        wanted = set(cores).union(tails).difference(self.pieces, other)
        self._fill(list(wanted))
        self.pieces.update(zip(other, self._alone(other), strict=True))
        get = self.pieces.__getitem__
        ids = list(map(operator.add, map(get, cores), map(get, tails)))
        for key in other:
            del self.pieces[key]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        return np.frombuffer(b"".join(ids), "<u4"), lengths


def _only_letters(core: str) -> bool:
    """Whether a word is letters alone, also once it is normalised.

    A letter's normal form can end in a combining mark, which the tokenizer would join
    with the marks after the word.
    """
    return core.isalpha() and unicodedata.normalize("NFC", core).lower().isalpha()


def _flat(normalizer: dict | None) -> list[dict]:
    """The normalizer's steps."""
    return (normalizer or {}).get("normalizers", [normalizer] if normalizer else [])


_LOADED: dict[tuple[str, bool], Tokens] = {}


def loaded(path: str, special: bool) -> Tokens:
    if (path, special) not in _LOADED:
        _LOADED[path, special] = Tokens(path, special)
    return _LOADED[path, special]


@dataclass(frozen=True)
class IdFiles:
    """A written set of id files: ``files`` as (part, uri, ids before it, documents), and the rank table."""

    root: str
    files: list[tuple[int, str, int, int]]
    by_rank: bytes  # ids in rank order, unsigned 32-bit


def write(
    docs: DataFrame,
    root: str,
    tokenizer: str,
    end_id: int,
    text: str = "text",
    key: str = "doc_id",
    special: bool = False,
) -> IdFiles:
    """Tokenise ``docs`` and write its id files under ``root``, in ascending order of ``key``.

    A null text counts as empty and has only the end id; rows with a null key come
    first and keep it; rows of equal key are ordered by their text; columns beside
    ``key`` and ``text`` are ignored.  No document: no file.  ``special``: whether
    the strings of special tokens inside a text become those tokens (the library's
    default) or are ordinary text.  A very long text is tokenised whole, in one step of
    one task, and its ids stay together: memory grows with the longest text.
    """
    spark = prepare(docs.sparkSession)
    ordered = (
        docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .repartitionByRange(shuffle_partitions(spark), "key")
        .sortWithinPartitions("key", "text")
    )

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        tokens = loaded(tokenizer, special)
        counts = np.zeros(max(tokens.size, end_id + 1), np.int64)
        keys, lengths = [], []

        def save(out):
            with zstandard.ZstdCompressor(level=1).stream_writer(out, closefd=False) as packed:
                for batch in batches:
                    texts = strings(batch.column(1))
                    keys.extend(batch.column(0).to_pylist())
                    for a, b in slices(texts, SLICE):
                        end = np.array([end_id], np.uint32)
                        found = tokens.table.texts(texts[a:b])
                        ids = np.concatenate([x for one in found for x in (one, end)])
                        lengths.extend(len(x) + 1 for x in found)
                        counts[:] += np.bincount(ids, minlength=len(counts))
                        packed.write(ids.astype("<u2" if len(counts) <= 1 << 16 else "<u4").tobytes())

        write_atomically(f"{root}/raw/{part:08d}.ids", save)
        if not keys:
            return
        write_atomically(
            f"{root}/raw/{part:08d}.docs",
            lambda out: out.write(json.dumps({"keys": keys, "lengths": lengths, "ids": len(counts)}).encode()),
        )
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(seen), part), pa.int32()), pa.array(seen, pa.int64()), pa.array(counts[seen], pa.int64())],
            ["part", "id", "n"],
        )

    counted = staged(ordered.mapInArrow(tokenise, "part int, id long, n long"), "id-counts")
    by_id = counted.groupBy("id").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "id").collect()  # vocabulary size
    by_rank = np.array([r["id"] for r in by_id], "<u4").tobytes()
    parts = sorted((r["part"], r["n"]) for r in counted.groupBy("part").agg(F.sum("n").alias("n")).collect())
    if not parts:
        return IdFiles(root, [], by_rank)
    shared = spark.sparkContext.broadcast(by_rank)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = np.frombuffer(shared.value, "<u4").astype(np.int64)
        ranks = np.zeros(int(ids.max()) + 1, np.uint32)
        ranks[ids] = np.arange(len(ids), dtype=np.uint32)
        for batch in batches:
            for part in batch.column(0).to_pylist():
                head = json.loads(read_bytes(f"{root}/raw/{part:08d}.docs"))
                width = "<u2" if head["ids"] <= 1 << 16 else "<u4"
                raw = zstandard.ZstdDecompressor().decompressobj().decompress(read_bytes(f"{root}/raw/{part:08d}.ids"))
                values = ranks[np.frombuffer(raw, width)]

                def save(out, head=head, values=values):
                    table = json.dumps({"keys": head["keys"], "lengths": head["lengths"]}).encode()
                    out.write(MAGIC + struct.pack("<QQ", len(table), len(values)) + table)
                    for a in range(0, len(values), BLOCK_IDS):
                        block = values[a : a + BLOCK_IDS]
                        control, data = encode_block(block)
                        out.write(struct.pack("<QQQ", len(block), len(control), len(data)) + control + data)

                write_atomically(file_name(root, part), save)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([len(head["keys"])], pa.int64())], ["part", "documents"]
                )

    todo = spark.createDataFrame([(p,) for p, _ in parts], "part int").repartition(len(parts))
    written = {r["part"]: r["documents"] for r in todo.mapInArrow(rank, "part int, documents long").collect()}
    files, before = [], 0
    for part, n in parts:
        files.append((part, file_name(root, part), before, written[part]))
        before += n
    write_atomically(f"{root}/ids/ranks.u32", lambda out: out.write(by_rank))
    return IdFiles(root, files, by_rank)


def file_name(root: str, part: int) -> str:
    return f"{root}/ids/part-{part:08d}.llids"


def read(spark: SparkSession, written: IdFiles) -> DataFrame:
    """One row per document of the id files: ``doc_id``, ``start``, ``ids`` (little-endian unsigned 32-bit)."""
    prepare(spark)
    schema = "doc_id long, start long, ids binary"
    if not written.files:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(written.by_rank)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_rank = np.frombuffer(shared.value, "<u4")
        for batch in batches:
            for uri, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys, lengths, values = read_file(uri)
                ids = by_rank[values]
                ends = np.cumsum(lengths)
                for a in range(0, len(keys), 500):
                    some = slice(a, a + 500)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys[some], pa.int64()),
                            pa.array(before + (ends - lengths)[some], pa.int64()),
                            pa.array(
                                [ids[e - n : e].tobytes() for e, n in zip(ends[some].tolist(), lengths[some].tolist(), strict=True)],
                                pa.binary(),
                            ),
                        ],
                        ["doc_id", "start", "ids"],
                    )

    todo = spark.createDataFrame([(uri, before) for _, uri, before, _ in written.files], "uri string, before long")
    return todo.repartition(len(written.files)).mapInArrow(decode, schema)


def read_file(uri: str) -> tuple[list, np.ndarray, np.ndarray]:
    """(keys, ids of each document, ranks of all ids) of one id file."""
    raw = memoryview(read_bytes(uri))
    if raw[:8] != MAGIC:
        raise ValueError(f"{uri} is not an id file")
    table, total = struct.unpack("<QQ", raw[8:24])
    head = json.loads(bytes(raw[24 : 24 + table]))
    values, at, done = np.zeros(total, np.uint32), 24 + table, 0
    while done < total:
        n, controls, size = struct.unpack("<QQQ", raw[at : at + 24])
        at += 24
        values[done : done + n] = decode_block(raw[at : at + controls], raw[at + controls : at + controls + size], n)
        at, done = at + controls + size, done + n
    return head["keys"], np.array(head["lengths"], np.int64), values
