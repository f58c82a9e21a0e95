"""Integer vectors for the vector operators: cleaning, packed blocks, exact products, best lists.

A packed block is one row that holds a bounded number of vectors as bytes, so that
a task gets them as one matrix.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# a score or limit that no product reaches: 2^62 is exact as a float
NONE = -(1 << 62)
# rows of one packed block: its products with a block of queries are a few MB
BLOCK_ROWS = 1024
BLOCK_SCHEMA = "n int, dim int, kind string, rows binary, ids binary, vectors binary"


def integer_vectors(df: DataFrame, key: str, vector: str, scale: int, **keep: Column) -> DataFrame:
    """``row, id, x, norm2`` and the columns of ``keep`` for the rows that take part.

    ``x`` is ``floor(scale * component)`` as longs (components as doubles), ``norm2``
    its squared length, ``row`` a number of the row itself: rows that repeat an id
    stay rows of their own.  A null id or vector and a null or non-finite component
    keep a row out.  ``row`` is only stable once the result is written.
    """
    value, inf = F.col(f"`{vector}`"), F.lit(float("inf"))
    whole = F.transform(value, lambda v: F.floor(v.cast("double") * scale))
    usable = F.col(f"`{key}`").isNotNull() & F.forall(value, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < inf))
    return (
        df.where(value.isNotNull() & usable)
        .select(F.col(f"`{key}`").cast("long").alias("id"), whole.alias("x"), *(c.alias(n) for n, c in keep.items()))
        .withColumn("norm2", F.aggregate("x", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))
        .withColumn("row", F.monotonically_increasing_id())
    )


def blocks_of(rows: int, most: int) -> int:
    return max(1, math.ceil(rows / most))


def block_number(row: Column, blocks: int) -> Column:
    """A block of a row, whatever its id or vector: no value can fill one block."""
    return F.pmod(F.xxhash64(row), F.lit(blocks)).cast("int")


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column as a matrix of 64-bit integers, shorter vectors filled with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    dim = int(lengths.max(initial=0))
    if (lengths == dim).all():
        return flat.reshape(len(lengths), dim).astype(np.int64)
    out = np.zeros((len(lengths), dim), np.int64)
    out[np.arange(dim) < lengths[:, None]] = flat
    return out


def packed(x: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> dict:
    """The fields of ``BLOCK_SCHEMA``; components take the fewest bytes that hold them."""
    least, most = (int(x.min()), int(x.max())) if x.size else (0, 0)
    kind = next(k for k in ("i2", "i4", "i8") if np.iinfo(k).min <= least and most <= np.iinfo(k).max)
    return {
        "n": len(x), "dim": x.shape[1], "kind": kind, "vectors": x.astype(f"<{kind}").tobytes(),
        "rows": rows.astype("<i8").tobytes(), "ids": ids.astype("<i8").tobytes(),
    }


def unpacked(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vectors, rows, ids) of a packed block."""
    x = np.frombuffer(block["vectors"], f"<{block['kind']}").reshape(block["n"], block["dim"])
    return x, np.frombuffer(block["rows"], "<i8"), np.frombuffer(block["ids"], "<i8")


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of ``a`` and ``b``, exact in the type that they come in.

    A vector that is shorter than the other counts as filled with zeros.  Products
    beyond 64 bits wrap.
    """
    dim = min(a.shape[1], b.shape[1])
    a, b = a[:, :dim], b[:, :dim]
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.float32)
    reach = dim * max(-int(a.min()), int(a.max()), 1) * max(-int(b.min()), int(b.max()), 1)
    kind = np.float32 if reach < 1 << 24 else np.float64 if reach < 1 << 53 else np.int64
    return a.astype(kind) @ b.astype(kind).T


class BestLists:
    """The first ``k`` offers of each owner: higher scores first, ties by id, then row."""

    def __init__(self, owners: int, k: int):
        self.owners, self.k = owners, k
        self.owner, self.score, self.id, self.row = (np.zeros(0, np.int64) for _ in range(4))

    def offer(self, owner: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Take offers in; the k-th score of every owner afterwards (``NONE`` if it has fewer)."""
        joined = [np.concatenate([mine, more.astype(np.int64)]) for mine, more in
                  ((self.owner, owner), (self.score, score), (self.id, ids), (self.row, rows))]
        # ~score falls as the score rises, without the overflow of a minus sign
        order = np.lexsort((joined[3], joined[2], ~joined[1], joined[0]))
        by_owner = joined[0][order]
        place = np.arange(len(order)) - np.searchsorted(by_owner, by_owner)
        order = order[place < self.k]
        self.owner, self.score, self.id, self.row = (c[order] for c in joined)
        last = np.full(self.owners, NONE, np.int64)
        full = place[place < self.k] == self.k - 1
        last[self.owner[full]] = self.score[full]
        return last
