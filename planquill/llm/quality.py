"""Quality classifier: Naive Bayes support vectors over character n-gram indicators.

A document is the set of its character 1-, 2- and 3-grams and of the 1- to 5-grams of the sequence that says of each word whether it
repeats the one before, all hashed into ``BUCKETS`` indicators. Each
indicator is scaled by the log-count ratio of the classes, a linear hinge-loss model is fitted to
the scaled indicators by dual coordinate descent with class-balanced costs, and margins
are turned into probabilities by a logistic curve over cross-validated margins.

The fit takes at most ``SAMPLE_ROWS`` labelled rows, those with the smallest hashes of their ids; a
row reaches the driver as BUCKETS / 8 bytes at most, so the sample is bounded in bytes too. Scoring reads
every document whole.

Defined results: null and empty texts have no indicators and score by the intercept; a document
labelled both ways, or with a null, teaches nothing; repeated rows are scored alike; without two classes every
score is the share of label 1 (0.5 without labels); null ids pass through; empty tables give empty
results; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import batched, documents_of

BUCKETS = 1 << 16
SAMPLE_ROWS = 4_000
ACCEPT = 0.7
#: Folds of the sample whose margins, each from a fit on the others, set the logistic curve.
FOLDS = 4
#: Longest n-grams of characters, and of the sequence that says of each word whether it repeats the one before.
CHARACTERS = 3
REPEATS = 5


def indicators(text: str) -> np.ndarray:
    """Sorted buckets of the n-grams in a text."""
    seen = np.zeros(BUCKETS, dtype=bool)
    words = text.split()
    again = np.fromiter((a == b for a, b in zip(words, words[1:], strict=False)), dtype=np.uint64, count=max(len(words) - 1, 0))
    _mark(seen, np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64), range(1, CHARACTERS + 1), 0)
    _mark(seen, again, range(1, REPEATS + 1), CHARACTERS)
    return np.flatnonzero(seen)


def _mark(seen: np.ndarray, c: np.ndarray, lengths: range, kind: int) -> None:
    """Mark the buckets of a sequence's n-grams; the hash of one starts from its length and kind."""
    for n in lengths:
        if len(c) >= n:
            h = np.full(len(c) - n + 1, kind + n, dtype=np.uint64)
            for k in range(n):
                h = (h ^ c[k : len(c) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            seen[(h >> np.uint64(7)) & np.uint64(BUCKETS - 1)] = True


@dataclass
class NbSvm:
    """``weights`` by bucket, the squared scale of each bucket, and the logistic curve."""

    weights: np.ndarray
    squares: np.ndarray
    intercept: float
    slope: float
    shift: float

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(indicators(text)) + self.shift, -35, 35))))

    def margin(self, x: np.ndarray) -> float:
        """Of a row scaled to length one, as in the fit."""
        return float((self.weights[x].sum() + self.intercept) / np.sqrt(self.squares[x].sum() + 1))


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Log of an indicator's share in class 1 over that in class 0. The one count that smooths is divided
    by the sizes of the classes, so that an indicator never seen says nothing."""
    sizes, counts = np.array([(y < 0).sum(), (y > 0).sum()], dtype=float), np.zeros((2, BUCKETS))
    for x, label in zip(rows, y, strict=True):
        counts[int(label > 0), x] += 1
    shares = (counts + (sizes / sizes.sum())[:, None]) / sizes[:, None]
    return np.log(shares[1] / shares[0])


def dual_descent(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: float = 1.0, epochs: int = 25, tolerance: float = 1e-3, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and intercept (a constant feature) of the L2-regularised hinge loss, found by
    coordinate descent on the dual variables; each row has length one, and its box is its class's balanced cost."""
    scale = [1 / np.sqrt(float(ratio[x] @ ratio[x]) + 1) for x in rows]
    values = [(ratio[x] * s).astype(np.float32) for x, s in zip(rows, scale, strict=True)]
    upper = np.where(y > 0, cost * len(y) / (2 * max((y > 0).sum(), 1)), cost * len(y) / (2 * max((y < 0).sum(), 1)))
    w, b, alpha, rng = np.zeros(BUCKETS), 0.0, np.zeros(len(y)), np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(y)):
            x, v = rows[i], values[i]
            g = y[i] * (float(w[x] @ v) + b * scale[i]) - 1
            if (alpha[i] == 0 and g >= 0) or (alpha[i] == upper[i] and g <= 0):
                continue
            worst = max(worst, abs(g))
            new = min(max(alpha[i] - g, 0.0), upper[i])
            step = (new - alpha[i]) * y[i]
            w[x] += step * v
            b += step * scale[i]
            alpha[i] = new
        if worst < tolerance:
            break
    return w * ratio, float(b)


def logistic(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through (margin, label), by Newton steps on smoothed targets."""
    up, down = (y > 0).sum(), (y < 0).sum()
    t = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    size = max(float(np.abs(margins).mean()), 1e-9)
    x, (a, b) = margins / size, (1.0, 0.0)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -35, 35)))
        v = p * (1 - p) + 1e-9
        g, h = np.array([(x * (p - t)).sum(), (p - t).sum()]), np.array([[(x * x * v).sum() + 1e-3, (x * v).sum()], [(x * v).sum(), v.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
        if np.abs(step).max() < 1e-7:
            break
    return max(float(a), 1e-6) / size, float(b)


def fit(rows: list[np.ndarray], labels: np.ndarray) -> NbSvm:
    """Model of rows of indicators and labels 0 and 1."""
    y = np.where(np.asarray(labels) > 0, 1.0, -1.0)
    if len(set(y.tolist())) < 2:
        p = (1.0 if y[0] > 0 else 0.0) if len(y) else 0.5
        return NbSvm(np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 1.0, float(np.log((p + 1e-3) / (1 - p + 1e-3))))
    model = _fitted(rows, y)
    # Margins of rows that a fold's own fit did not see tell how far to trust a margin.
    fold, order = np.zeros(len(y), dtype=int), np.argsort(y, kind="stable")
    fold[order] = np.arange(len(y)) % FOLDS
    margins = np.array([model.margin(x) for x in rows])
    for k in range(FOLDS):
        own = fold != k
        if min((own & (y > 0)).sum(), (own & (y < 0)).sum()) and not own.all():
            part = _fitted([rows[i] for i in np.flatnonzero(own)], y[own])
            margins[~own] = [part.margin(rows[i]) for i in np.flatnonzero(~own)]
    model.slope, model.shift = logistic(margins, y)
    return model


def _fitted(rows: list[np.ndarray], y: np.ndarray) -> NbSvm:
    ratio = log_count_ratio(rows, y)
    w, c = dual_descent(rows, y, ratio)
    return NbSvm(w, ratio**2, c, 1.0, 0.0)


def held_out(doc_id: Column) -> Column:
    """The rows whose labels are never learnt from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> NbSvm:
    """Fit on a bounded sample of the labelled documents that are not held out."""
    label = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("most"))
        .where("label = most")
        .select("doc_id", "label")
    )
    # The sample has at most sample_rows ids, 12 bytes each: broadcast whatever the corpus.
    chosen = label.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    # Of an id's several texts the smallest teaches, so that the fit does not depend on the order of rows.
    rows = documents_of(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    schema = "doc_id long, label int, bits binary"

    def work(columns: dict) -> Iterator[tuple]:
        for doc_id, text, y in zip(columns["doc_id"], columns["text"], columns["label"], strict=True):
            seen = np.zeros(BUCKETS, dtype=bool)
            seen[indicators(text)] = True
            yield doc_id, y, zlib.compress(np.packbits(seen).tobytes(), 1)

    # Sent packed and kept as two-byte numbers: the driver holds a few kilobytes a row at most.
    sample = [(r["doc_id"], r["label"], _unpacked(r["bits"])) for r in rows.mapInArrow(batched(schema, work, ["doc_id", "text", "label"]), schema).collect()]
    sample.sort(key=lambda r: r[0])
    return fit([x for *_, x in sample], np.array([y for _, y, _ in sample]))


def _unpacked(bits: bytes) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.frombuffer(zlib.decompress(bits), dtype=np.uint8))).astype(np.uint16)


def score(docs: DataFrame, model: NbSvm, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1, higher: label 1 likelier) of every row, from its text alone."""
    schema = "doc_id long, score double"
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers

    def work(columns: dict) -> Iterator[tuple]:
        m = shared.value
        for doc_id, text in zip(columns["doc_id"], columns["text"], strict=True):
            yield doc_id, m.score(text)

    return documents_of(docs, id_col, text_col).mapInArrow(batched(schema, work, ["doc_id", "text"]), schema)


def accepted(docs: DataFrame, model: NbSvm, least: float = ACCEPT) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores ``least`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(texts):
        m = shared.value
        return texts.fillna("").map(m.score).astype(float)

    return docs.where(scores(F.col("text").cast("string")) >= least)
