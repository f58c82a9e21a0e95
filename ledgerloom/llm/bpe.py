"""Operator 10: byte-level BPE encoding and decoding by merge replay over the corpus.

1. Every task reports the distinct chunks (pre-tokens with the white space before
   them) of each group of ``GROUP`` characters of its texts.
2. The chunks are dealt by hash, packed by bucket, so that a chunk of many texts
   comes to one task.  There the distinct pieces are laid out as one long symbol array, an
   inverted index maps every token pair (by the rank of its merge) to the positions
   where it stands, and the merges are applied in rank order, touching only the
   neighbours of a merged pair.
3. The ids go back to the groups that asked for them, as a written table sorted by
   group, and the documents take their ids from the table of their own group: no
   document is shuffled, and a group's table is bounded by ``GROUP`` characters.

A chunk over ``LONG_CHUNK`` characters is replayed where it stands, as is any chunk
that the table lacks (rows dealt otherwise when they are read again).  Ids equal
those of the tiktoken library.
"""

from __future__ import annotations

import base64
import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerloom.llm import chunks
from ledgerloom.llm.common import filesystem, prepare, shuffle_partitions, slices, strings, tidy
from ledgerloom.session import scratch_path

# characters of one vectorised step
SLICE = 2_000_000
# characters of the rows that share one table of chunks
GROUP = 16_000_000
# longer chunks hardly repeat: they are not shuffled
LONG_CHUNK = 200
# chunks kept in a task that replays them (memory only)
KEPT_CHUNKS = 1_000_000
# rows of a written chunk table read at once
TABLE_ROWS = 32
NONE = np.int64(1) << 40  # rank of a pair that never merges


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file: token bytes to id."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class MergeReplay:
    """Encodes many words at once by replaying the merges in rank order over all of them."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = rank
        self.keys = np.fromiter(sorted(pairs), np.int64, len(pairs))
        self.values = np.fromiter((pairs[k] for k in self.keys.tolist()), np.int64, len(pairs))
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each merged pair, ``NONE`` where there is no such merge (or no neighbour: -1)."""
        if not len(self.keys):
            return np.full(len(left), NONE)
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.values[at], NONE)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after the other, number of ids of each)."""
        whole = np.fromiter((self.ranks.get(w, -1) for w in words), np.int64, len(words))
        split = np.flatnonzero(whole < 0)
        ids, counts = self._replay([words[i] for i in split.tolist()])
        lengths = np.ones(len(words), np.int64)
        lengths[split] = counts
        out = np.repeat(whole, lengths)
        out[np.repeat(whole < 0, lengths)] = ids
        return out, lengths

    def _replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        n = int(sizes.sum())
        if not n:
            return np.zeros(0, np.int64), sizes
        ends = np.cumsum(sizes)
        word = np.repeat(np.arange(len(words)), sizes)
        # one spare place at the end is the neighbour of every first and last symbol
        symbol = np.append(self.byte_ids[np.frombuffer(b"".join(words), np.uint8)], -1)
        after, before = np.minimum(np.arange(1, n + 2), n), np.arange(-1, n)
        full = sizes > 0
        after[ends[full] - 1] = n
        before[(ends - sizes)[full]] = n
        alive = np.ones(n + 1, bool)
        rank_at = self.pair_rank(symbol, symbol[after])
        rank_at[n] = NONE
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(positions: np.ndarray) -> None:
            """Enter positions in the inverted index under the rank of the pair that stands there."""
            ranks = rank_at[positions]
            positions, ranks = positions[ranks < NONE], ranks[ranks < NONE]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for rank, group in zip(ranks[np.append(0, cuts)].tolist(), np.split(positions, cuts), strict=True):
                if rank in index:
                    index[rank].append(group)
                else:
                    index[rank] = [group]
                    heapq.heappush(heap, rank)

        add(np.arange(n))
        while heap:
            rank = heapq.heappop(heap)
            places = index.pop(rank)
            at = np.unique(places[0] if len(places) == 1 else np.concatenate(places))
            at = at[alive[at] & (rank_at[at] == rank)]
            if not len(at):
                continue
            at, later = self._leftmost(at, rank, symbol, after, before, word)
            gone = after[at]
            right = after[gone]
            symbol[at] = rank
            after[at] = right
            before[right] = at
            alive[gone] = False
            left = before[at]
            rank_at[at] = self.pair_rank(symbol[at], symbol[right])
            rank_at[left] = self.pair_rank(symbol[left], symbol[after[left]])
            rank_at[n] = NONE
            add(np.concatenate([at, left[left < n], later]))
        alive = alive[:n]
        return symbol[:n][alive], np.bincount(word[alive], minlength=len(words))

    def _leftmost(self, at, rank, symbol, after, before, word):
        """Positions to merge now, and those that must wait for a new pair of lower rank.

        Of overlapping pairs (a run of equal symbols) every second one merges.
        Where a merge makes a pair of lower rank, only the word's first place
        merges now: the lower rank comes before the next place.
        """
        words = word[at]
        if (words[1:] != words[:-1]).all():
            return at, at[:0]
        overlaps = np.append(False, after[at[:-1]] == at[1:])
        number = np.arange(len(at))
        run_start = np.maximum.accumulate(np.where(overlaps, 0, number))
        chosen = at[(number - run_start) % 2 == 0]
        gone = after[chosen]
        merged = np.full(len(chosen), rank)
        right = self.pair_rank(merged, symbol[after[gone]])
        left_symbol = symbol[before[chosen]]
        joined = np.append(False, before[chosen[1:]] == gone[:-1])
        left = self.pair_rank(np.where(joined, rank, left_symbol), merged)
        lower = (right < rank) | (left < rank)
        if not lower.any():
            return chosen, at[:0]
        careful = np.isin(word[chosen], np.unique(word[chosen[lower]]))
        first = np.append(True, word[chosen[1:]] != word[chosen[:-1]])
        waiting = careful & ~first
        return chosen[~waiting], chosen[waiting]


class ByteBpe:
    """Encoder and decoder of one rank file, with the worker's table of distinct chunks."""

    def __init__(self, path: str, pattern: str):
        import regex

        ranks = load_ranks(path)
        self.replay = MergeReplay(ranks)
        self.width = "<u2" if self.replay.size <= 1 << 16 else "<u4"
        # the rank files' library takes \s as Unicode white space; this module's \s has more
        self.pattern = regex.compile(
            pattern.replace(r"[^\s", r"[^\p{White_Space}")
            .replace(r"(?!\S)", r"(?!\P{White_Space})")
            .replace(r"\s", r"\p{White_Space}")
        )
        self.table = chunks.ChunkTable(self.encode_chunks, chunks.split_keeping_space)
        by_id = {rank: token for token, rank in ranks.items()}
        tokens = [by_id.get(i, b"") for i in range(self.replay.size)]
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.token_starts = np.cumsum(self.token_lengths) - self.token_lengths

    def encode_chunks(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks one after the other, number of ids of each)."""
        matches = [self.pattern.findall(chunks.raw_chunk(k)) for k in keys]
        distinct = {m: i for i, m in enumerate(dict.fromkeys(m for ms in matches for m in ms))}
        ids, lengths = self.replay.encode([m.encode("utf-8") for m in distinct])
        starts = np.cumsum(lengths) - lengths
        counts = np.fromiter(map(len, matches), np.int64, len(matches))
        which = np.fromiter((distinct[m] for ms in matches for m in ms), np.int64, int(counts.sum()))
        ends = np.concatenate([[0], np.cumsum(lengths[which])])[np.cumsum(counts)]
        return chunks.expand(ids, starts[which], lengths[which]), np.diff(ends, prepend=0)

    def decode(self, ids: np.ndarray) -> bytes:
        ids = ids.astype(np.int64)
        return chunks.expand(self.token_bytes, self.token_starts[ids], self.token_lengths[ids]).tobytes()


_LOADED: dict[tuple[str, str], ByteBpe] = {}


def loaded(path: str, pattern: str) -> ByteBpe:
    """The worker's encoder of a rank file (built once per worker process)."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = ByteBpe(path, pattern)
    return _LOADED[path, pattern]


# --------------------------------------------------------------------------
# The corpus' distinct chunks
# --------------------------------------------------------------------------
class Groups:
    """Deals the rows of a task into groups of ``size`` characters, by the characters before them."""

    def __init__(self, size: int = GROUP) -> None:
        self.size, self.before = size, 0

    def ranges(self, texts: list[str]) -> Iterator[tuple[int, int, int]]:
        """(group, start, end) of runs of rows, each of about ``SLICE`` characters at most."""
        start, group = 0, self.before // self.size
        for i, text in enumerate(texts):
            if self.before // self.size != group:
                yield from ((group, start + a, start + b) for a, b in slices(texts[start:i], SLICE))
                start, group = i, self.before // self.size
            self.before += len(text)
        yield from ((group, start + a, start + b) for a, b in slices(texts[start:], SLICE))


def packed(lengths: np.ndarray, data: bytes) -> bytes:
    """Values of at most 65,535 units each, one after the other, with their lengths, compressed."""
    body = struct.pack("<I", len(lengths)) + lengths.astype("<u2").tobytes() + data
    return zstandard.ZstdCompressor(level=1).compress(body)


def unpacked(blob: bytes) -> tuple[np.ndarray, memoryview]:
    """(lengths, data) of ``packed``."""
    body = memoryview(zstandard.ZstdDecompressor().decompress(blob))
    (n,) = struct.unpack("<I", body[:4])
    return np.frombuffer(body[4 : 4 + 2 * n], "<u2").astype(np.int64), body[4 + 2 * n :]


def unpacked_chunks(blob: bytes) -> list[str]:
    lengths, data = unpacked(blob)
    offsets = np.append(0, np.cumsum(lengths)).astype(np.int32)
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(data)).to_pylist()


def wanted_chunks(df: DataFrame, text: str, size: int = GROUP) -> DataFrame:
    """(part, group, bucket, chunks): the distinct chunks of each group of rows of each task, dealt by their hash.

    A row holds the chunks of one bucket, packed.  There are as many buckets as twice
    the shuffle partitions.
    """
    buckets = 2 * shuffle_partitions(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, groups = TaskContext.get().partitionId(), Groups(size)
        now, found = 0, set()

        def out() -> Iterator[pa.RecordBatch]:
            keys = [k for k in found if len(k) <= LONG_CHUNK]
            if not keys:
                return
            bucket = (np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys)) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            dealt = pa.array(keys, pa.string()).take(pa.array(order))
            offsets = np.frombuffer(dealt.buffers()[1], np.int32, len(keys) + 1)
            data, lengths = memoryview(dealt.buffers()[2]), np.diff(offsets)
            which, starts = np.unique(bucket[order], return_index=True)
            ends = np.append(starts[1:], len(keys))
            blobs = [
                packed(lengths[a:b], bytes(data[offsets[a] : offsets[b]]))
                for a, b in zip(starts.tolist(), ends.tolist(), strict=True)
            ]
            same = (pa.array(np.full(len(which), x, np.int32)) for x in (part, now))
            yield pa.RecordBatch.from_arrays(
                [*same, pa.array(which), pa.array(blobs, pa.binary())], ["part", "group", "bucket", "chunks"]
            )

        for batch in batches:
            texts = strings(batch.column(0))
            for group, a, b in groups.ranges(texts):
                if group != now:
                    yield from out()
                    now, found = group, set()
                for one in texts[a:b]:
                    found.update(chunks.split_keeping_space(one))
        yield from out()

    return df.select(text).mapInArrow(tidy(run), "part int, group int, bucket int, chunks binary")


def with_ids(wanted: DataFrame, path: str, pattern: str) -> DataFrame:
    """Append ``ids``, the packed ids of the packed chunks of each row, replaying each distinct chunk of a bucket once.

    The table of a task's chunks starts afresh beyond ``KEPT_CHUNKS``; a chunk seen again is then replayed again.
    """

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[str]]]]:
        """Rows with about ``SLICE`` bytes of chunks."""
        for batch in batches:
            column, start, size, held = batch.column(3), 0, 0, []
            for i in range(batch.num_rows):
                held.append(unpacked_chunks(column[i].as_py()))
                size += sum(map(len, held[-1]))
                if size > SLICE or i + 1 == batch.num_rows:
                    yield batch.slice(start, i + 1 - start), held
                    start, size, held = i + 1, 0, []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pattern)
        table = chunks.ChunkTable(bpe.encode_chunks, list, keep=KEPT_CHUNKS)
        for rows, keys in steps(batches):
            blobs = [packed(lengths, ids.astype(bpe.width).tobytes()) for lengths, ids in table.chunk_ids(keys)]
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(blobs, pa.binary())], [*rows.schema.names, "ids"])

    return wanted.repartition("bucket").mapInArrow(
        tidy(run), "part int, group int, bucket int, chunks binary, ids binary"
    )


def write_chunk_table(df: DataFrame, path: str, pattern: str, text: str, size: int = GROUP) -> str:
    """Folder of the written chunk tables: a folder per task of ``df``, its rows in order of their group."""
    root = scratch_path(df.sparkSession, "chunk-ids")
    found = with_ids(wanted_chunks(df, text, size), path, pattern).drop("bucket")
    found.repartition("part").sortWithinPartitions("part", "group").write.partitionBy("part").parquet(root)
    return root


class GroupTables:
    """The chunk tables of one task's groups, read as a stream in ascending order of the group."""

    def __init__(self, root: str, part: int, width: str):
        from pyarrow import fs

        store, folder = filesystem(f"{root}/part={part}")
        files = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        self.rows = self._read(store, sorted(f.path for f in files if f.path.endswith(".parquet")))
        self.width = width
        self.ahead: tuple[int, bytes, bytes] | None = None

    @staticmethod
    def _read(store, names: list[str]) -> Iterator[tuple[int, bytes, bytes]]:
        import pyarrow.parquet as pq

        for name in names:
            with store.open_input_file(name) as f:
                for batch in pq.ParquetFile(f).iter_batches(TABLE_ROWS, columns=["group", "chunks", "ids"]):
                    yield from zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)

    def of(self, group: int) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(chunks, their ids one after the other, number of ids of each) of a group not before the last one."""
        keys: list[str] = []
        flat, lengths = [np.zeros(0, self.width)], [np.zeros(0, np.int64)]
        while True:
            row, self.ahead = self.ahead or next(self.rows, None), None
            if row is None or row[0] > group:
                self.ahead = row
                return keys, np.concatenate(flat), np.concatenate(lengths)
            if row[0] == group:
                keys.extend(unpacked_chunks(row[1]))
                counts, data = unpacked(row[2])
                lengths.append(counts)
                flat.append(np.frombuffer(data, self.width))


# --------------------------------------------------------------------------
# Documents
# --------------------------------------------------------------------------
def encode(
    df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """Append ``ids``: the token ids of ``text`` as little-endian unsigned 32-bit integers.

    With ``decoded``, a column of that name has the bytes that the ids decode to (as
    ``decode`` makes it, but in the same workers).  ``path`` must name the rank file on every executor.  A null or empty text
    has no ids (an empty value); other columns pass through, those of the new names
    are replaced.  Repeated rows are encoded each for itself; an empty table
    gives an empty table.  The texts are read twice: for the table of their
    chunks, which is written here, and for their ids.
    """
    prepare(df.sparkSession)
    made = [ids] if decoded is None else [ids, decoded]
    df = df.drop(*made)
    root = write_chunk_table(df, path, pattern, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pattern)
        tables, groups, now = GroupTables(root, TaskContext.get().partitionId(), bpe.width), Groups(), -1
        for batch in batches:
            texts = strings(batch.column(batch.schema.get_field_index(text)))
            for group, a, b in groups.ranges(texts):
                if group != now:
                    bpe.table.fill(*tables.of(group))
                    now = group
                found = [x.astype("<u4").tobytes() for x in bpe.table.texts(texts[a:b])]
                part = batch.slice(a, b - a)
                columns = [*part.columns, pa.array(found, pa.binary())]
                if decoded is not None:
                    columns.append(pa.array([bpe.decode(np.frombuffer(x, "<u4")) for x in found], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, *made])
        bpe.table.trim(0)

    return df.mapInArrow(tidy(run), T.StructType([*df.schema.fields, *(T.StructField(c, T.BinaryType()) for c in made)]))


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Append ``decoded``: the bytes that the ids of column ``ids`` stand for (null ids: no bytes)."""
    prepare(df.sparkSession)
    df = df.drop(decoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pattern)
        for batch in batches:
            found = [
                bpe.decode(np.frombuffer(x or b"", "<u4"))
                for x in batch.column(batch.schema.get_field_index(ids)).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.binary())], [*batch.schema.names, decoded]
            )

    return df.mapInArrow(tidy(run), T.StructType([*df.schema.fields, T.StructField(decoded, T.BinaryType())]))
