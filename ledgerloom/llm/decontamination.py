"""Operator 7: benchmark decontamination with a generalised suffix automaton.

The normalised test items form one suffix automaton over words, small enough
to broadcast (larger benchmarks are cut into blocks of items, one automaton and
one pass per block).  Every document streams its words through the automaton,
which keeps the longest suffix that occurs in an item; matches of a whole
window (``window`` item words, or a whole shorter item) mark their words as
hit, name the items, and can be cut from the text.
"""

from __future__ import annotations

import math
import pickle
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import prepare, staged, strings, tidy

WINDOW = 13
# Words of one automaton: about two states a word, some 100 MB in a worker.
BLOCK_WORDS = 200_000
# bytes of item text that count as one word when the number of blocks is chosen
BYTES_PER_WORD = 6

# bytes of words stay (A-Z in lower case), all others become blanks
_TABLE = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

MATCH_FIELDS = {
    "n_words": T.LongType(),
    "n_hit": T.LongType(),
    "hit_spans": T.ArrayType(T.ArrayType(T.LongType())),
    "hit_items": T.ArrayType(T.StringType()),
    "clean_text": T.StringType(),
}


def words_of(text: str) -> list[bytes]:
    """Lower-cased words: runs of a-z, 0-9 and non-ASCII characters, in UTF-8."""
    return text.encode("utf-8").translate(_TABLE).split()


class SuffixAutomaton:
    """Suffix automaton of word sequences, with the items behind every window."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for name, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            coded.append((name, ids))
            last = 0
            for c in ids:
                last = self._extend(last, c)
        self.least = min([window, *(len(ids) for _, ids in coded if ids)])
        # state whose strings have the window's length, on each state's suffix path
        order = sorted(range(len(self.link)), key=self.length.__getitem__)
        self.window_state = [-1] * len(self.link)
        for v in order:
            up = self.link[v]
            if self.length[v] >= window:
                self.window_state[v] = v if self.length[up] < window else self.window_state[up]
        found: dict[int, set] = {}
        short: dict[int, list[tuple[int, str | None]]] = {}
        for name, ids in coded:
            v = 0
            for n, c in enumerate(ids, 1):
                v = self.step[v][c]
                while self.length[self.link[v]] >= n:
                    v = self.link[v]
                if n >= window:
                    found.setdefault(self.window_state[v], set()).add(name)
            if 0 < len(ids) < window:
                short.setdefault(v, []).append((len(ids), name))
        self.window_items = {v: tuple(sorted(x for x in names if x is not None)) for v, names in found.items()}
        # whole short items that end where a state's string ends
        self.short: dict[int, tuple] = {}
        for v in order[1:]:
            own = (*short.get(v, ()), *self.short.get(self.link[v], ()))
            if own:
                self.short[v] = own

    def _extend(self, last: int, c: int) -> int:
        step, link, length = self.step, self.link, self.length
        if c in step[last]:
            q = step[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        new = self._state({}, length[last] + 1, 0)
        p = last
        while p != -1 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p != -1:
            q = step[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return new

    def _clone(self, p: int, c: int, q: int) -> int:
        copy = self._state(dict(self.step[q]), self.length[p] + 1, self.link[q])
        self.link[q] = copy
        while p != -1 and self.step[p].get(c) == q:
            self.step[p][c] = copy
            p = self.link[p]
        return copy

    def _state(self, step: dict[int, int], length: int, link: int) -> int:
        self.step.append(step)
        self.length.append(length)
        self.link.append(link)
        return len(self.link) - 1

    def matches(self, words: list[bytes]) -> tuple[list[list[int]], set[str]]:
        """(half-open word spans that windows cover, names of the items with those windows)."""
        spans: list[list[int]] = []
        names: set[str] = set()
        known = bytes(map(self.vocabulary.__contains__, words))
        step, link, length = self.step, self.link, self.length
        # a window needs a run of words that all occur in items
        for run in re.finditer(b"\x01{%d,}" % self.least, known):
            v = n = 0
            for i in range(run.start(), run.end()):
                c = self.vocabulary[words[i]]
                while v and c not in step[v]:
                    v = link[v]
                    n = length[v]
                v = step[v][c]
                n += 1
                reach = n if n >= self.window else 0
                if reach:
                    names.update(self.window_items[self.window_state[v]])
                for size, name in self.short.get(v, ()):
                    if size <= n:
                        reach = max(reach, size)
                        if name is not None:
                            names.add(name)
                if reach:
                    start = i + 1 - reach
                    while spans and start <= spans[-1][0]:
                        spans.pop()
                    if spans and start <= spans[-1][1]:
                        spans[-1][1] = i + 1
                    else:
                        spans.append([start, i + 1])
        return spans, names


def merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def without(text: str, spans: list[list[int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    if not spans:
        return text
    raw = text.encode("utf-8")
    at = [m.span() for m in _WORD.finditer(raw)]
    kept, done = [], 0
    for start, end in spans:
        kept.append(raw[done : at[start][0]])
        done = at[end - 1][1]
    return b"".join([*kept, raw[done:]]).decode("utf-8")


def automata(items: DataFrame, item_id: str, text: str, most: int, window: int) -> DataFrame:
    """A written table of pickled automata, each over the items of one block of about ``most`` words.

    Blocks are dealt by the hash of the item; their number comes from the bytes of all
    items.  Each automaton is built in the task of its block.
    """
    named = items.select(F.col(item_id).cast("string").alias("name"), F.coalesce(F.col(text), F.lit("")).alias("item")).distinct()
    size = named.agg(F.sum(F.octet_length("item"))).first()[0] or 0
    n = max(1, math.ceil(size / (BYTES_PER_WORD * most)))
    dealt = named.select(F.pmod(F.xxhash64("name", "item"), F.lit(n)).cast("int").alias("block"), "name", "item")

    def build(key: tuple, table: pa.Table) -> pa.Table:
        names, texts = table["name"].to_pylist(), table["item"].to_pylist()
        made = SuffixAutomaton([(x, words_of(t)) for x, t in zip(names, texts, strict=True)], window)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "automaton": pa.array([pickle.dumps(made)], pa.binary())})

    return staged(dealt.groupBy("block").applyInArrow(build, "block int, automaton binary"), "automata")


def scan(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    prefix: str = "",
) -> DataFrame:
    """Append what of each document occurs in the items; the new columns' names follow ``prefix``.

    ``n_words``; ``n_hit``, words inside an occurrence of a window; ``hit_spans``,
    their half-open word ranges; ``hit_items``, ids (as text, sorted) of the items
    with an occurring window; ``clean_text``, the text without the spans.  A null or
    empty text has no words, a null or empty item no window; an item without an
    id hits words but is not listed; repeated rows count each for itself; columns
    of the new names are replaced.  No items or no documents: nothing is hit.

    Items of more than ``block_words`` words are cut into blocks with one pass each; the
    result is written between passes, so a task holds one automaton at a time.
    """
    spark = prepare(docs.sparkSession)
    fields = [T.StructField(prefix + name, kind) for name, kind in MATCH_FIELDS.items()]
    if text in (f.name for f in fields):
        raise ValueError(f"column {text} has the name of a result column")
    kept = docs.drop(*(f.name for f in fields))
    schema = T.StructType([*kept.schema.fields, *fields])
    built = automata(items, item_id, item_text, block_words, window)
    numbers = [r["block"] for r in built.select("block").sort("block").collect()]
    if not numbers:
        return kept.mapInArrow(tidy(_pass(None, None, text, [f.name for f in fields], True, window)), schema)
    out = kept
    for k, number in enumerate(numbers):
        if k:
            out = staged(out, "decontamination-pass")
            shared.unpersist()
        # one block's automaton: its size is bounded by ``block_words``
        shared = spark.sparkContext.broadcast(built.where(F.col("block") == number).first()["automaton"])
        name = uuid.uuid4().hex
        out = out.mapInArrow(tidy(_pass(shared, name, text, [f.name for f in fields], k == 0, window)), schema)
    return out


# the automaton that this worker has unpickled, under the name of its pass
_HELD: dict[str, SuffixAutomaton] = {}


def _automaton(shared, name: str | None, window: int) -> SuffixAutomaton:
    if shared is None:
        return SuffixAutomaton([], window)
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = pickle.loads(shared.value)
    return _HELD[name]


def _pass(shared, name: str | None, text: str, fields: list[str], first: bool, window: int):
    """One block's pass over the documents; later passes add to what earlier ones found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(shared, name, window)
        for batch in batches:
            kept = [x for x in batch.schema.names if x not in fields]
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            n_words, n_hit, all_spans, all_items, clean = [], [], [], [], []
            for i, value in enumerate(strings(columns[text])):
                words = words_of(value)
                spans, found = automaton.matches(words)
                if not first:
                    spans = merged(spans + columns[fields[2]][i].as_py())
                    found.update(columns[fields[3]][i].as_py())
                n_words.append(len(words))
                n_hit.append(sum(b - a for a, b in spans))
                all_spans.append(spans)
                all_items.append(sorted(found))
                clean.append(without(value, spans))
            yield pa.RecordBatch.from_arrays(
                [
                    *(columns[x] for x in kept),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_hit, pa.int64()),
                    pa.array(all_spans, pa.list_(pa.list_(pa.int64()))),
                    pa.array(all_items, pa.list_(pa.string())),
                    pa.array(clean, pa.string()),
                ],
                [*kept, *fields],
            )

    return run


def is_contaminated(coverage: int = 20, prefix: str = "") -> Column:
    """At least one word in ``coverage`` is hit."""
    hit = F.col(f"{prefix}n_hit")
    return (hit > 0) & (hit * coverage >= F.col(f"{prefix}n_words"))


def decontaminate(
    docs: DataFrame, items: DataFrame, text: str = "text", coverage: int = 20, cut: bool = False, **how
) -> DataFrame:
    """Documents whose hit words stay under the coverage limit, unchanged.

    A document over the limit goes, or with ``cut`` stays without its hit spans.
    Columns are those of ``docs``, whatever their names; clean documents keep
    their text as it is.
    """
    prefix = "decontaminate_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix += "_"
    found = scan(docs, items, text=text, prefix=prefix, **how)
    over = is_contaminated(coverage, prefix)
    if not cut:
        return found.where(~over).select(docs.columns)
    return found.withColumn(text, F.when(over, F.col(f"{prefix}clean_text")).otherwise(F.col(text))).select(docs.columns)
