"""Quality classifier: a generalised additive model with pairwise interactions.

Features are read off whole texts (FEATURES) and cut into at most BINS bins at quantiles of the training rows. Boosting goes round the features: each
step fits a shallow tree of LEAVES leaves over the bins of one feature to the current log-loss, and adds a small part of it to that
feature's look-up table. Then the PAIRS of features whose quadrants leave most loss get two-way tables, fitted the same way by two-cut
trees. A score is a sum of looked-up values, taken for a whole batch at once.

Features of all documents are computed once and written to the shared folder; the model, a few kilobytes, is fitted on the driver from
at most MOST_LABELLED labelled rows (the first by hash of the id), which bounds its memory at any corpus size.

Defined edge cases: null and empty texts have features of zero and a score like any other; documents with a null id are held out and
scored; repeated label rows each count; rows with a null label are not learned from; without labels every score is 0.5; an empty table gives
no rows. Labels, lang, source and doc_id are never inputs of a score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ids_and_texts, raw_texts, shared, slices, table, written

FEATURES = ["words", "word_length", "upper", "digits", "symbols", "stops", "other_ascii", "high_bytes", "distinct", "top_word", "repeated_lines", "line_words", "exclaimed", "short_words"]
BINS, LEAVES, ROUNDS, RATE, PAIRS, PAIR_ROUNDS = 48, 4, 120, 0.1, 6, 40
MOST_LABELLED = 200_000
FOLDS, HELD = 5, 0


def _of(chars: bytes) -> np.ndarray:
    out = np.zeros(256)
    out[list(chars)] = 1
    return out


CLASSES = np.stack([_of(bytes(range(65, 91))), _of(b"0123456789"), _of(b"#*$%&|<>"), _of(b".,;:?"), _of(b"!\"'()+-/=@[\\]^_`{}~"), _of(bytes(range(128, 256))), _of(b" \t\n\x0b\x0c\r")])


def features(text: bytes | None) -> np.ndarray:
    out = np.zeros(len(FEATURES))
    words = text.split() if text else []
    if not words:
        return out
    n = len(words)
    counts = CLASSES @ np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = max(len(text) - counts[6], 1)
    kinds = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    out[:] = [
        np.log1p(n), chars / n, counts[0] / chars, counts[1] / chars, counts[2] / chars, counts[3] / n, counts[4] / n, counts[5] / chars, len(kinds) / n, max(kinds.values()) / n,
        1 - len(set(lines)) / len(lines), np.log1p(n / len(lines)), text.count(b"!!") / n, sum(c for w, c in kinds.items() if len(w) <= 3) / n,
    ]
    return out


def featured(docs: DataFrame) -> DataFrame:
    """doc_id, x (array of FEATURES) for each row of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                x = [features(t) for t in raw_texts(batch)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])

    return docs.mapInArrow(run, "doc_id long, x array<double>")


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = LEAVES, ridge: float = 1.0) -> np.ndarray:
    """Values of the bins (gradient and hessian sums g, h) under the best tree of so many leaves, grown cut by cut."""
    parts, cg, ch = [(0, len(g))], np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    worth = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + ridge)
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for a, b in parts:
            if b - a > 1:
                m = np.arange(a + 1, b)
                gain = worth(a, m) + worth(m, b) - worth(a, b)
                if gain.max() > best[0]:
                    best = (gain.max(), (a, b), int(m[gain.argmax()]))
        if best[1] is None:
            break
        a, b = best[1]
        parts.remove((a, b))
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = -(cg[b] - cg[a]) / (ch[b] - ch[a] + ridge)
    return out


def _tree2(g: np.ndarray, h: np.ndarray, ridge: float = 1.0) -> tuple[float, np.ndarray]:
    """Gain and values of a two-way table cut once on each side."""
    cg, ch = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))
    a, b = np.meshgrid(np.arange(1, g.shape[0]), np.arange(1, g.shape[1]), indexing="ij")

    def quarters(c: np.ndarray) -> list[np.ndarray]:
        nw, n, w, t = c[a, b], c[a, -1], c[-1, b], c[-1, -1]
        return [nw, n - nw, w - nw, t - n - w + nw]

    gs, hs = quarters(cg), quarters(ch)
    gain = sum(x * x / (y + ridge) for x, y in zip(gs, hs, strict=True))
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    out = np.zeros(g.shape)
    for k, (x, y) in enumerate(zip(gs, hs, strict=True)):
        rows, cols = (slice(None, i + 1), slice(i + 1, None))[k // 2], (slice(None, j + 1), slice(j + 1, None))[k % 2]
        out[rows, cols] = -x[i, j] / (y[i, j] + ridge)
    return float(gain[i, j] - cg[-1, -1] ** 2 / (ch[-1, -1] + ridge)), out


class Model:
    """edges: cut points by feature; tables: values by bin; pairs: two-way values."""

    def __init__(self, width: int):
        self.edges = [np.zeros(0)] * width
        self.tables: list[np.ndarray] = [np.zeros(1)] * width
        self.pairs: dict[tuple[int, int], np.ndarray] = {}
        self.bias = 0.0

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)], axis=1)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        out = np.full(len(x), self.bias)
        for k, t in enumerate(self.tables):
            out += t[b[:, k]]
        for (i, j), t in self.pairs.items():
            out += t[b[:, i], b[:, j]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    model = Model(x.shape[1])
    if not len(y):
        return model
    mean = (y.sum() + 1) / (len(y) + 2)
    model.bias = float(np.log(mean / (1 - mean)))
    model.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    b = model.bins(x)
    sizes = [len(e) + 1 for e in model.edges]
    model.tables = [np.zeros(n) for n in sizes]
    f = np.full(len(y), model.bias)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-f))
        return p - y, p * (1 - p)

    for _ in range(ROUNDS):
        for k, n in enumerate(sizes):
            g, h = slopes()
            step = RATE * _tree(np.bincount(b[:, k], g, n), np.bincount(b[:, k], h, n))
            model.tables[k] += step
            f += step[b[:, k]]

    def two_way(i: int, j: int) -> tuple[float, np.ndarray]:
        g, h = slopes()
        at, n = b[:, i] * sizes[j] + b[:, j], sizes[i] * sizes[j]
        return _tree2(np.bincount(at, g, n).reshape(sizes[i], -1), np.bincount(at, h, n).reshape(sizes[i], -1))

    every = [(i, j) for i in range(len(sizes)) for j in range(i) if min(sizes[i], sizes[j]) > 1]
    for i, j in sorted(every, key=lambda p: (-two_way(*p)[0], p))[:PAIRS]:
        model.pairs[i, j] = np.zeros((sizes[i], sizes[j]))
    for _ in range(PAIR_ROUNDS):
        for i, j in model.pairs:
            step = RATE * two_way(i, j)[1]
            model.pairs[i, j] += step
            f += step[b[:, i], b[:, j]]
    return model


def learned(known: DataFrame, labels: DataFrame, label: str = "quality", most: int = MOST_LABELLED) -> Model:
    """A model of `label` from rows of known (doc_id, x) that labels covers and no held-out fold holds."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("y")).where("y IN (0, 1) AND doc_id IS NOT NULL").where(F.crc32(F.col("doc_id").cast("string")) % FOLDS != HELD)
    rows = own.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(most).select("x", "y").toArrow()
    x = np.array(rows.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    return fit(x, rows.column("y").to_numpy())


def scored(known: DataFrame, model: Model) -> DataFrame:
    sent = shared(known.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent()
        for batch in batches:
            x = batch.column("x").values.to_numpy().reshape(-1, len(FEATURES)) if batch.num_rows else np.zeros((0, len(FEATURES)))
            x = x[batch.column("x").offset : batch.column("x").offset + batch.num_rows]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"])

    return known.mapInArrow(run, "doc_id long, score double")


def op4_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = written(featured(ids_and_texts(table(spark, sf_dir, "documents"))), "features")
    out = scored(known, learned(known, table(spark, sf_dir, "labels")))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD, F.lit(True))
    return out.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).cast("int").alias("predicted"))
