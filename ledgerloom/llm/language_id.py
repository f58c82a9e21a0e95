"""Operator 4: language identification by error-correcting output codes over character n-grams.

Every language has a codeword.  For each bit a binary classifier of hashed
letter bigrams and trigrams tells the languages with a 1 from those with a 0;
its weights are log-odds of corpus counts, taken in one distributed pass over
all labelled texts.  A text is decoded to the codeword of least weighted loss,
and flagged where two codewords are nearly as good.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import prepare, slices, strings, tidy

SYMBOLS = 256
BIGRAMS = SYMBOLS * SYMBOLS
TRIGRAMS = 1 << 16
GRAMS = BIGRAMS + TRIGRAMS
SMOOTHING = 0.5
# a text is ambiguous if its best two languages' scores are nearer than this
AMBIGUOUS = 0.1
UNDETERMINED = "und"
# known n-grams that every text is granted, so that few rare ones do not condemn a short text
GRANTED_GRAMS = 4
# characters of one vectorised step (some 180 bytes of work space each); a longer text is counted in pieces
SLICE = 300_000
# languages of a model: the driver holds this many rows of GRAMS numbers
MOST_LANGUAGES = 200


def _symbol_table() -> np.ndarray:
    """Symbol of each code point below 65536: 0 for no letter, else 1 to 255 by the lower-case letter."""
    table = np.zeros(1 << 16, np.uint32)
    for c in range(1 << 16):
        if chr(c).isalpha():
            table[c] = 1 + ord(chr(c).lower()[0]) * 2654435761 % 2**32 % 255 if c > 127 else ord(chr(c).lower()) - 64
    return table


_TABLE: list[np.ndarray] = []


def grams_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram numbers of all texts, first gram of each text, letters of each text)."""
    if not _TABLE:
        _TABLE.append(_symbol_table())
    blank = "  "
    points = np.frombuffer("".join(blank + t for t in texts).encode("utf-32-le"), np.uint32)
    symbols = _TABLE[0][np.minimum(points, 0xFFFF)]
    high = points > 0xFFFF
    if high.any():
        letters = np.array([chr(c).isalpha() for c in points[high].tolist()])
        symbols[high] = np.where(letters, 1 + points[high] % 255, 0)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + len(blank)
    text_at = np.repeat(np.arange(len(texts)), sizes)
    a, b, c = symbols[:-2], symbols[1:-1], symbols[2:]
    # grams end at each place from the third on; blanks part the texts
    two = b * SYMBOLS + c
    three = (((a * SYMBOLS + b) * SYMBOLS + c) * np.uint32(2654435761) >> np.uint32(16)) + BIGRAMS
    kept = (b > 0) | (c > 0)
    owner = text_at[2:]
    count = np.bincount(owner[kept], minlength=len(texts)) * 2
    grams = np.stack([two[kept], three[kept]], axis=1).reshape(-1)
    letters_of = np.bincount(text_at[symbols > 0], minlength=len(texts))
    return grams, np.cumsum(count) - count, letters_of


def histogram_of(text: str, piece: int = SLICE) -> tuple[np.ndarray, int]:
    """(how often each gram occurs, number of letters) of one text, counted piece by piece."""
    total, letters = np.zeros(GRAMS, np.int64), 0
    for start in range(0, len(text), piece):
        before = max(0, start - 2)
        grams, _, found = grams_of([text[before : start + piece]])
        total += np.bincount(grams, minlength=GRAMS)
        letters += int(found[0])
        if start:  # the two characters before the piece were counted with the piece before it
            grams, _, found = grams_of([text[before:start]])
            total -= np.bincount(grams, minlength=GRAMS)
            letters -= int(found[0])
    return total, letters


def codewords(k: int, seed: int = 11) -> np.ndarray:
    """``k`` codewords of -1 and 1: all distinct splits for few languages, else the best of random codes."""
    if k <= 1:
        return np.ones((k, 1))
    if k <= 6:
        bits = [[1 if (split >> i) & 1 else -1 for i in range(k)] for split in range(1, 2 ** (k - 1))]
        return np.array(bits).T.astype(float)
    rng = np.random.default_rng(seed)
    width = int(np.ceil(10 * np.log2(k)))
    best, least = None, -1
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], size=(k, width))
        code[0, (code == code[0]).all(axis=0)] *= -1  # a bit that is equal for all tells nothing
        apart = min(int((code[i] != code[i + 1 :]).sum(axis=1).min()) for i in range(k - 1))
        if apart > least:
            best, least = code, apart
    return best


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # grams x bits, log-odds
    expected: np.ndarray  # languages x bits: the margin of a typical text of the language
    usual: np.ndarray  # languages x grams: more frequent in the language than if all grams were equally frequent


def fit(df: DataFrame, label: str = "lang", text: str = "text") -> Model:
    """Bit classifiers from every row of ``df`` with a label (the caller leaves out held-out rows).

    Rows without label or text teach nothing.  The counts that come to the driver
    have at most languages x 131,072 rows, whatever the corpus; a label column of more than
    ``MOST_LANGUAGES`` values is refused with a ValueError before anything is counted.
    """
    prepare(df.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            labels, texts = batch.column(0).to_pylist(), strings(batch.column(1))
            for name in dict.fromkeys(labels):
                own = [t for t, x in zip(texts, labels, strict=True) if x == name]
                total = totals.setdefault(name, np.zeros(GRAMS, np.int64))
                for a, b in slices(own, SLICE):
                    long = b - a == 1 and len(own[a]) > SLICE
                    total += histogram_of(own[a])[0] if long else np.bincount(grams_of(own[a:b])[0], minlength=GRAMS)
        for name, total in totals.items():
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(seen), pa.string()), pa.array(seen, pa.int32()), pa.array(total[seen])],
                ["label", "gram", "n"],
            )

    labelled = df.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(label).cast("string").alias("label"), F.col(text).alias("text")
    )
    languages = labelled.select("label").distinct().limit(MOST_LANGUAGES + 1).count()
    if languages > MOST_LANGUAGES:
        raise ValueError(f"column {label} has more than {MOST_LANGUAGES} languages")
    summed = labelled.mapInArrow(tidy(count), "label string, gram int, n long").groupBy("label", "gram").agg(F.sum("n").alias("n"))
    rows = summed.toPandas()
    return train(rows["label"].to_numpy(), rows["gram"].to_numpy(), rows["n"].to_numpy())


def train(labels: np.ndarray, grams: np.ndarray, counts: np.ndarray) -> Model:
    """Model of (language, gram, count) triples."""
    languages = sorted(set(labels.tolist()))
    number = {x: i for i, x in enumerate(languages)}
    share = np.full((len(languages), GRAMS), SMOOTHING)
    np.add.at(share, ([number[x] for x in labels], grams.astype(np.int64)), counts)
    share /= share.sum(axis=1, keepdims=True)
    code = codewords(len(languages))
    weights = np.zeros((GRAMS, code.shape[1]))
    for j in range(code.shape[1]):
        if (code[:, j] > 0).any() and (code[:, j] < 0).any():
            weights[:, j] = np.log(share[code[:, j] > 0].mean(axis=0)) - np.log(share[code[:, j] < 0].mean(axis=0))
    return Model(languages, code, weights.astype(np.float32), share @ weights, share > 1 / GRAMS)


def decode(model: Model, margins: np.ndarray) -> np.ndarray:
    """Scores (texts x languages, rows sum to 1) of mean margins (texts x bits).

    The loss of a bit is logistic in the margin, in units of the margin that a
    typical text of that language has; bits that separate a language better weigh
    more in its loss.
    """
    unit = np.maximum(np.abs(model.expected), 1e-6)
    weight = unit / unit.sum(axis=1, keepdims=True)
    z = 4.0 * margins[:, None, :] * model.code[None] / unit[None]
    loss = (np.logaddexp(0.0, -z) * weight[None]).sum(axis=2)
    score = np.exp(-4.0 * loss)
    return score / score.sum(axis=1, keepdims=True)


def predict(df: DataFrame, model: Model, text: str = "text", prefix: str = "") -> DataFrame:
    """Append ``lang_pred``, ``score`` (0 to 1), ``ambiguous`` and ``known``, each after ``prefix``, to every row.

    The scores of the learned languages sum to 1, so the best says nothing about
    other languages; ``known``, the share of the text's n-grams that are usual in the
    predicted language, does.  A null text, or one without a letter, is ``und`` with
    score and share 0 and ambiguous; so is every text where no language was learned.  Ties go to the language that
    sorts first.  Columns of the same names are replaced.
    """
    spark = prepare(df.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    out = [
        T.StructField(f"{prefix}lang_pred", T.StringType()),
        T.StructField(f"{prefix}score", T.DoubleType()),
        T.StructField(f"{prefix}ambiguous", T.BooleanType()),
        T.StructField(f"{prefix}known", T.DoubleType()),
    ]
    kept = df.drop(*(f.name for f in out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = strings(batch.column(batch.schema.names.index(text)))
            found: list[tuple[str, float, bool, float]] = []
            for a, b in slices(texts, SLICE):
                found += classify(model, texts[a:b])
            made = zip(*found, strict=True) if found else ((), (), (), ())
            kinds = (pa.string(), pa.float64(), pa.bool_(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(values, kind) for values, kind in zip(made, kinds, strict=True))],
                [*batch.schema.names, *(f.name for f in out)],
            )

    return kept.mapInArrow(tidy(run), T.StructType([*kept.schema.fields, *out]))


def classify(model: Model, texts: list[str]) -> list[tuple[str, float, bool, float]]:
    if not model.languages:
        return [(UNDETERMINED, 0.0, True, 0.0)] * len(texts)
    if len(texts) == 1 and len(texts[0]) > SLICE:
        return [_classify_long(model, texts[0])]
    grams, first, letters = grams_of(texts)
    ends = np.append(first[1:], len(grams))
    sums = np.zeros((len(texts), model.code.shape[1]))
    some = ends > first
    if some.any():
        sums[some] = np.add.reduceat(model.weights[grams], first[some], axis=0, dtype=np.float64)
    scores = decode(model, sums / np.maximum(ends - first, 1)[:, None])
    best = scores.argmax(axis=1)
    ordered = np.sort(scores, axis=1)
    gap = ordered[:, -1] - ordered[:, -2] if scores.shape[1] > 1 else np.ones(len(texts))
    n = ends - first
    seen = np.append(0, np.cumsum(model.usual[np.repeat(best, n), grams]))
    known = (seen[ends] - seen[first] + GRANTED_GRAMS) / (n + GRANTED_GRAMS)
    return [
        (model.languages[k], float(scores[i, k]), bool(gap[i] < AMBIGUOUS), float(known[i]))
        if letters[i]
        else (UNDETERMINED, 0.0, True, 0.0)
        for i, k in enumerate(best.tolist())
    ]


def _classify_long(model: Model, text: str) -> tuple[str, float, bool, float]:
    """``classify`` of one text from its histogram, so that memory does not grow with its length."""
    counts, letters = histogram_of(text)
    if not letters:
        return (UNDETERMINED, 0.0, True, 0.0)
    n, seen = int(counts.sum()), np.flatnonzero(counts)
    scores = decode(model, (counts[seen] @ model.weights[seen].astype(np.float64) / n)[None])[0]
    best = int(scores.argmax())
    ordered = np.sort(scores)
    gap = ordered[-1] - ordered[-2] if len(scores) > 1 else 1.0
    known = (int(counts[model.usual[best]].sum()) + GRANTED_GRAMS) / (n + GRANTED_GRAMS)
    return (model.languages[best], float(scores[best]), bool(gap < AMBIGUOUS), float(known))


def is_rejected(least: float = 0.3, prefix: str = "", least_known: float = 0.5) -> Column:
    """No language, one with a score under ``least``, or one in which too few of the text's n-grams are usual."""
    return (
        (F.col(f"{prefix}lang_pred") == UNDETERMINED)
        | (F.col(f"{prefix}score") < least)
        | (F.col(f"{prefix}known") < least_known)
    )
