"""Token ids of many texts through a table of their distinct chunks.

Texts repeat words, so a worker tokenises each distinct chunk once and looks
the rest up: one dictionary step per chunk, everything else is vectorised.
Chunks end where no token can cross, so the ids equal those of the whole text.
"""

from __future__ import annotations

import itertools
import re
from collections import defaultdict
from collections.abc import Callable

import numpy as np

# Chunks kept between batches; beyond it only the frequent ones stay (memory only,
# the ids are the same either way).
KEPT_CHUNKS = 400_000

_BOUNDARY = re.compile(r"(?<=\S)(?=[ \n]\S)")


def split_keeping_space(text: str) -> list[str]:
    """Chunks of ``text``, each a white-space character and the run after it, as table keys.

    A key is `` word`` without its space, ``\\nword`` as it stands, or a NUL
    and the raw chunk.  Cuts fall only before one blank or newline that stands
    between two non-blank characters.
    """
    if not text:
        return []
    if len(" ".join(text.split())) != len(text) or "\0" in text:  # white space in a row or at an end
        return ["\0" + x for x in _BOUNDARY.split(text)]
    parts = text.replace("\n", " \n").split(" ")
    parts[0] = "\0" + parts[0]
    return parts


def raw_chunk(key: str) -> str:
    """The characters that a key of ``split_keeping_space`` stands for."""
    if key[0] == "\0":
        return key[1:]
    return key if key[0] == "\n" else " " + key


def split_dropping_space(text: str) -> list[str]:
    """Chunks between blanks and newlines, for tokenizers that drop white space."""
    return text.replace("\n", " ").split(" ")


def expand(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``flat[starts[i] : starts[i] + lengths[i]]`` of all i, one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return flat[np.repeat(starts - before, lengths) + np.arange(total)]


class ChunkTable:
    """Ids of distinct chunks, filled on demand by ``encode(list of keys) -> (ids, lengths)``."""

    def __init__(self, encode: Callable, split: Callable, dtype=np.uint32, keep: int = KEPT_CHUNKS):
        self.encode, self.split, self.dtype, self.keep = encode, split, dtype, keep
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = defaultdict(itertools.count().__next__)
        self.ids = np.zeros(0, self.dtype)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.seen = np.zeros(0, np.int64)
        self.filled = 0

    def fill(self, keys: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        """Start afresh from distinct chunks whose ids are known, one after the other in ``ids``."""
        self._clear()
        self.index = defaultdict(itertools.count(len(keys)).__next__, zip(keys, range(len(keys)), strict=True))
        self.ids, self.lengths = ids.astype(self.dtype), lengths.astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.seen = np.zeros(len(keys), np.int64)
        self.filled = len(keys)

    def trim(self, most: int) -> None:
        """Keep the chunks seen most often, at most ``most``."""
        if len(self.index) <= most:
            return
        often = np.argsort(-self.seen, kind="stable")[:most]
        often = np.sort(often[self.seen[often] > 1])
        keys, ids = list(self.index), expand(self.ids, self.starts[often], self.lengths[often])
        lengths, seen = self.lengths[often], self.seen[often]
        self._clear()
        for i in often.tolist():
            self.index[keys[i]]  # numbered in this order
        self.ids, self.lengths, self.seen = ids, lengths, seen
        self.starts = np.cumsum(lengths) - lengths

    def _numbers(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the chunks of all texts one after the other, how many each text has); new chunks are encoded."""
        if len(self.index) > self.keep + self.filled:
            self.trim(self.keep // 2)
        known = len(self.starts)
        chunks = [self.split(t) for t in texts]
        counts = np.fromiter(map(len, chunks), np.int64, len(chunks))
        found = np.fromiter(
            map(self.index.__getitem__, itertools.chain.from_iterable(chunks)), np.int64, int(counts.sum())
        )
        if len(self.index) > known:
            new = list(itertools.islice(self.index, known, None))
            ids, lengths = self.encode(new)
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.ids = np.concatenate([self.ids, ids.astype(self.dtype)])
        seen = np.bincount(found, minlength=len(self.starts))
        seen[: len(self.seen)] += self.seen
        self.seen = seen
        return found, counts

    def chunk_ids(self, texts: list) -> list[tuple[np.ndarray, np.ndarray]]:
        """(number of ids of each chunk, the ids of all its chunks) of each text."""
        found, counts = self._numbers(texts)
        each = np.split(found, np.cumsum(counts)[:-1]) if texts else []
        return [(self.lengths[at], expand(self.ids, self.starts[at], self.lengths[at])) for at in each]

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        found, counts = self._numbers(texts)
        lengths = self.lengths[found]
        out = expand(self.ids, self.starts[found], lengths)
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(counts)]
        return np.split(out, ends[:-1]) if len(texts) else []
