"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are taken from whole texts on the executors. The trees are fitted on
the driver from a bounded table of statistics, then flattened into arrays so
that a batch walks all trees level by level in numpy.
"""

from __future__ import annotations

import operator
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.llm.base import batch, fit_rows, fresh, id_text, join_few, utf8

#: Labelled rows that a fit may use, chosen by a hash of their ids.
FIT_ROWS = 20_000

STATISTICS = ("log_bytes", "lower", "upper", "digit", "blank", "stop", "symbol", "bar", "wide", "entropy", "word_bytes", "word_spread", "distinct_words", "repeat_words", "distinct_lines", "line_bytes")

_CLASSES = np.full(256, 6, dtype=np.uint8)
for _i, _set in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\r", b".,;:'\"-?()")):
    _CLASSES[list(_set)] = _i
_CLASSES[ord("|")] = 7
_CLASSES[128:] = 8


def statistics(text: bytes) -> list[float]:
    """The statistics of one text; all zero if it is empty."""
    n = len(text)
    if not n:
        return [0.0] * len(STATISTICS)
    histogram = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    shares = np.bincount(_CLASSES, weights=histogram, minlength=9) / n
    p = histogram[histogram > 0] / n
    words, lines = text.split(), text.split(b"\n")
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    w = max(1, len(words))
    return [
        float(np.log1p(n)),
        *shares[[0, 1, 2, 3, 4, 6, 7, 8]].tolist(),
        float(-(p * np.log2(p)).sum()),
        float(sizes.mean()) if len(words) else 0.0,
        float(sizes.std()) if len(words) else 0.0,
        len(set(words)) / w,
        sum(map(operator.eq, words, words[1:])) / w,
        len(set(lines)) / len(lines),
        float(np.log1p(n / len(lines))),
    ]


@dataclass
class Trees:
    """Complete trees of one depth, flattened: heap-ordered inner nodes and leaves of each tree."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        trees, inner = self.feature.shape
        node = np.zeros((len(x), trees), dtype=np.int64)
        rows, cols = np.arange(len(x))[:, None], np.arange(trees)
        for _ in range(inner.bit_length()):
            node = 2 * node + 1 + (x[rows, self.feature[cols, node]] > self.threshold[cols, node])
        return self.base + self.leaf[cols, node - inner].sum(axis=1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def fit_trees(x: np.ndarray, y: np.ndarray, *, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15, l2: float = 1.0, least: int = 5) -> Trees:
    """Newton boosting of the log loss on binned features. One class or no rows: the base rate alone."""
    p = (float(y.sum()) + 0.5) / (len(y) + 1)
    base, inner = float(np.log(p / (1 - p))), 2**depth - 1
    empty = Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), base)
    if len(y) == 0 or y.min() == y.max():
        return empty
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    width = bins + 1
    margin, made = np.full(len(y), base), []
    for _ in range(trees):
        q = 1 / (1 + np.exp(-margin))
        g, h = q - y, q * (1 - q)
        node = np.zeros(len(y), dtype=np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            best = np.zeros(count)
            for f, e in enumerate(edges):
                at = (node - first) * width + binned[:, f]
                hist = [np.bincount(at, weights=v, minlength=count * width).reshape(count, width).cumsum(axis=1) for v in (g, h, np.ones(len(y)))]
                (gl, gt), (hl, ht), (nl, nt) = ((c[:, :-1], c[:, -1:]) for c in hist)
                gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
                gain[(nl < least) | (nt - nl < least)] = 0
                k = gain.argmax(axis=1)
                for i in np.flatnonzero(gain[np.arange(count), k] > best + 1e-9):
                    if k[i] < len(e):
                        best[i], feature[first + i], threshold[first + i] = gain[i, k[i]], f, e[k[i]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        at = node - inner
        leaf = -rate * np.bincount(at, weights=g, minlength=inner + 1) / (np.bincount(at, weights=h, minlength=inner + 1) + l2)
        margin += leaf[at]
        made.append((feature, threshold, leaf))
    return Trees(*(np.stack([m[i] for m in made]) for i in range(3)), base)


_STATS = pa.schema([("doc_id", pa.int64()), ("stats", pa.list_(pa.float64()))])
_SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def _matrix(column: pa.Array) -> np.ndarray:
    data, at = utf8(column)
    return np.array([statistics(data[a:b].tobytes()) for a, b in zip(at, at[1:], strict=False)], dtype=np.float64).reshape(-1, len(STATISTICS))


def fit_quality(docs: DataFrame, labels: DataFrame, *, rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Trees:
    """Fit on ``labels`` (doc_id, label), at most ``rows`` of them.

    Labels other than 0 and 1, nulls among them, are left out. A null text counts as
    empty, and both are examples like others. A label given twice, or an id with
    several texts, makes a row each time. Without any labelled text every score is 0.5.
    """
    keys = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label")).filter("label IN (0, 1) AND doc_id IS NOT NULL")
    keys = fit_rows(keys, "doc_id", rows)

    @fresh
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield batch(_STATS, b.column("label").cast(pa.int64()), list(_matrix(b.column("text"))))

    got = join_few(id_text(docs, id_col, text_col), keys, "doc_id").select("text", "label").mapInArrow(run, "doc_id long, stats array<double>").toPandas()
    x = np.array(got["stats"].tolist(), dtype=np.float64).reshape(-1, len(STATISTICS))
    y = got["doc_id"].to_numpy(dtype=np.float64)
    order = np.lexsort((y, *x.T))  # the fit doesn't depend on the order in which rows come
    return fit_trees(x[order], y[order])


def score_quality(docs: DataFrame, trees: Trees, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every whole text: doc_id, score in 0..1.

    A null or empty text is scored by its (all zero) statistics. Repeated rows
    each give a row, equal texts equal scores; extra columns are ignored.
    """

    @fresh
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield batch(_SCORES, b.column("doc_id"), trees.predict(_matrix(b.column("text"))))

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")
