"""Document quality by a generalised additive model with pairwise interactions.

Every feature of a text is cut into bins; cyclic boosting visits the features in turn and adds to each feature's lookup table the
leaf values of a shallow tree fitted to the current gradients, then does the same for the pairs of features that lower the
loss most. A score is the sigmoid of a sum of table entries, so documents are scored by vectorised lookups.
Only the text is read: language, source and id are no inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roamgrid.llm.shared import fold, slices, training_rows

FEATURES = ("log_words", "word_length", "upper_share", "symbol_share", "digit_share", "comma_stop_share", "bar_share",
            "bang_share", "other_bytes_share", "upper_words", "distinct_words", "repeated_next", "distinct_triples",
            "top_word", "symbol_words", "distinct_lines", "line_words", "space_share")
_UPPER, _LOWER, _DIGIT, _STOP, _BAR, _BANG, _SYMBOL, _SPACE, _HIGH = range(9)


def _byte_classes() -> np.ndarray:
    kinds = np.full(256, _SYMBOL, dtype=np.int64)
    kinds[128:] = _HIGH
    kinds[65:91], kinds[97:123], kinds[48:58] = _UPPER, _LOWER, _DIGIT
    for characters, kind in ((b".,;:'", _STOP), (b"|", _BAR), (b"!?", _BANG), (b" \t\n\r\x0b\x0c", _SPACE)):
        kinds[np.frombuffer(characters, dtype=np.uint8)] = kind
    return kinds


_CLASSES = _byte_classes()


def features(text: str | None) -> np.ndarray:
    """The features of one whole text; all are zero for a text without words."""
    out = np.zeros(len(FEATURES))
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return out
    n, size = len(words), len(data)
    counts = np.bincount(_CLASSES[np.frombuffer(data, dtype=np.uint8)], minlength=9)
    letters = max(1, counts[_UPPER] + counts[_LOWER] + counts[_HIGH])
    seen: dict[bytes, int] = {}
    codes = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=n)
    triples = codes[:-2] * n * n + codes[1:-1] * n + codes[2:] if n > 2 else codes
    lines = [line for line in data.split(b"\n") if line.strip()]
    out[:] = (
        np.log1p(n), (size - counts[_SPACE]) / n, counts[_UPPER] / letters, counts[_SYMBOL] / size, counts[_DIGIT] / size,
        counts[_STOP] / n, counts[_BAR] / n, counts[_BANG] / n, counts[_HIGH] / size,
        sum(w.isupper() and len(w) > 1 for w in seen) / len(seen), len(seen) / n, np.mean(codes[1:] == codes[:-1]) if n > 1 else 0,
        len(np.unique(triples)) / len(triples), np.bincount(codes).max() / n,
        sum(not w[-1:].isalnum() and w[-1] < 128 and w[-1:] not in b".,;:" for w in seen) / len(seen),
        len(set(lines)) / len(lines), n / len(lines), counts[_SPACE] / size)
    return out


@dataclass
class Gam:
    """Bin edges and lookup tables; ``pairs`` are (feature, feature, grid over the coarse bins of both)."""

    edges: list[np.ndarray]
    intercept: float
    tables: list[np.ndarray]
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        at = self.bins(x)
        total = np.full(len(x), self.intercept)
        for j, values in enumerate(self.tables):
            total += values[at[:, j]]
        for i, j, grid in self.pairs:
            total += grid[self.coarse[i][at[:, i]], self.coarse[j][at[:, j]]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _leaves(g: np.ndarray, h: np.ndarray, depth: int, l2: float) -> np.ndarray:
    """Leaf values, by bin, of a tree over consecutive bins fitted to sums of gradients and second derivatives."""
    value = np.full(len(g), g.sum() / (h.sum() + l2))
    if depth and len(g) > 1:
        left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gain = left_g**2 / (left_h + l2) + (g.sum() - left_g) ** 2 / (h.sum() - left_h + l2)
        at = int(np.argmax(gain)) + 1
        if gain[at - 1] > g.sum() ** 2 / (h.sum() + l2) + 1e-9:
            value = np.r_[_leaves(g[:at], h[:at], depth - 1, l2), _leaves(g[at:], h[at:], depth - 1, l2)]
    return value


def _grid_leaves(g: np.ndarray, h: np.ndarray, l2: float) -> tuple[float, np.ndarray]:
    """The gain and the values of the best tree that cuts both axes of a grid once."""
    def corner(x):
        c = x.cumsum(0).cumsum(1)
        a, right, below = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1]
        return np.stack([a, right - a, below - a, c[-1, -1] - right - below + a])
    gs, hs = corner(g), corner(h)
    gain = (gs**2 / (hs + l2)).sum(0)
    r, c = np.unravel_index(int(np.argmax(gain)), gain.shape)
    v = gs[:, r, c] / (hs[:, r, c] + l2)
    rows, cols = np.arange(g.shape[0])[:, None] > r, np.arange(g.shape[1])[None, :] > c
    return float(gain[r, c] - g.sum() ** 2 / (h.sum() + l2)), np.choose(2 * rows + cols, list(v))


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 120, pairs: int = 10, rate: float = 0.1,
        depth: int = 2, l2: float = 2.0) -> Gam:
    """Fit tables to features ``x`` and labels ``y`` (0 or 1). Without rows the score is 1/2; with one class, near it."""
    count = x.shape[1]
    prior = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(prior / (1 - prior)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if len(y) else np.zeros(0)
             for j in range(count)]
    model = Gam(edges, start, [np.zeros(len(e) + 1) for e in edges])
    if len(y) < 2 or y.min() == y.max():
        return model
    at, total = model.bins(x), np.full(len(y), start)

    def gradients():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j in range(count):
            g, h = gradients()
            size = len(model.tables[j])
            step = rate * _leaves(np.bincount(at[:, j], g, size), np.bincount(at[:, j], h, size), depth, l2)
            model.tables[j] += step
            total += step[at[:, j]]

    grid = 8
    model.coarse = [np.arange(len(e) + 1) * grid // (len(e) + 1) for e in edges]
    low = [c[at[:, j]] for j, c in enumerate(model.coarse)]

    def grid_sums(i, j):
        g, h = gradients()
        cell = low[i] * grid + low[j]
        return (np.bincount(cell, v, grid * grid).reshape(grid, grid) for v in (g, h))

    gains = [(_grid_leaves(*grid_sums(i, j), l2)[0], i, j) for i in range(count) for j in range(i)]
    chosen = [(i, j, np.zeros((grid, grid))) for _, i, j in sorted(gains, reverse=True)[:pairs]]
    for _ in range(rounds // 2):
        for i, j, values in chosen:
            step = rate * _grid_leaves(*grid_sums(i, j), l2)[1]
            values += step
            total += step[low[i], low[j]]
    model.pairs = chosen
    return model


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = [features(t).tolist() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(rows, pa.list_(pa.float64()))], names=["y", "x"])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000) -> Gam:
    """Fit to ``labels.quality`` of at most ``max_rows`` documents outside fold 0; only their features reach the driver."""
    rows = (training_rows(docs, labels, "quality", max_rows, F.col("text").cast("string").alias("text"))
            .select("y", "text").mapInArrow(_feature_rows, "y int, x array<double>").toArrow())
    y = np.array(rows.column("y"), dtype=float)
    x = np.array(rows.column("x").to_pylist(), dtype=float).reshape(len(y), len(FEATURES))
    return fit(x, y)


def score(docs: DataFrame, model: Gam, name: str = "score") -> DataFrame:
    """The input with a column ``name``: the probability of label 1, also for null and empty texts."""
    columns = [c for c in docs.columns if c != name]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(shared.value.score(np.stack([features(t) for t in texts])) if len(texts) else np.zeros(0))

    return docs.select(*[F.col(f"`{c}`") for c in columns], run(F.col("text").cast("string")).alias(name))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_rows: int = 12_000) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document, from a model fitted to the labels outside fold 0.

    Null and empty texts have the score of a text without words. Repeated rows get equal results. Extra columns are ignored;
    labels other than 0 and 1 and labels without a document are left out of the fit.
    """
    scored = score(docs.select("doc_id", "text"), train(docs, labels, max_rows))
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                         F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"))
