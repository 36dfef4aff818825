"""Quality rules: base rules, and gradient-boosted trees over document statistics.

Trees are grown by histograms on labelled documents, a bounded sample of them, and flattened into node arrays (complete
trees of equal depth), so that scoring a batch is a few array look-ups per level. The score may only fall as a chosen feature
grows: splits that would break that are not made, and the children's values stay on their side of the middle.

Defined results: a null text is empty and fails the base rules. Without labels of both kinds there are no trees, and
documents that pass the base rules are kept. A null label is no label. An empty table gives an empty result. Rows
repeated get equal results. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ontarmac.llm import common, text_stats
from ontarmac.session import cut

MAX_LABELLED = 40_000
TREES, DEPTH, BINS, RATE, MIN_WEIGHT, SMOOTH = 60, 4, 64, 0.2, 5.0, 1.0
#: Features in which the score never rises.
FALLING = ["symbols_per_char", "pipes_per_word", "bangs_per_word", "upper_share", "dup_line_share", "repeat_share", "same_as_last"]
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


@dataclass
class Trees:
    """Node arrays of complete trees: node ``i`` has children ``2i + 1`` (up to the threshold) and ``2i + 2``."""

    start: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    value: np.ndarray  # trees x leaves
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row."""
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = 2**self.depth - 1
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node - inner]
        return 1 / (1 + np.exp(-total))


def _best_split(grad, hess, falling, low, high):
    """Gain, feature, bin and child values of the best allowed split of one node; histograms are features x bins."""
    g, h = grad.cumsum(axis=1)[:, :-1], hess.cumsum(axis=1)[:, :-1]
    g_all, h_all = grad.sum(axis=1)[:, None], hess.sum(axis=1)[:, None]
    left = np.clip(-g / (h + SMOOTH), low, high)
    right = np.clip(-(g_all - g) / (h_all - h + SMOOTH), low, high)

    def worth(value, grad, hess):
        return -(grad * value + 0.5 * (hess + SMOOTH) * value**2)

    whole = np.clip(-g_all / (h_all + SMOOTH), low, high)
    gain = worth(left, g, h) + worth(right, g_all - g, h_all - h) - worth(whole, g_all, h_all)
    allowed = (h >= MIN_WEIGHT) & (h_all - h >= MIN_WEIGHT) & ~(falling[:, None] & (right > left))
    gain = np.where(allowed, gain, 0.0)
    at = np.unravel_index(np.argmax(gain), gain.shape)
    return gain[at], *map(int, at), left[at], right[at]


def fit(x: np.ndarray, y: np.ndarray, falling: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Grow trees for labels 0 and 1 by second-order boosting of the logistic loss."""
    n, width = x.shape
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T)], axis=1)
    start = float(np.log(y.mean() / (1 - y.mean())))
    total = np.full(n, start)
    inner = 2**depth - 1
    features, thresholds = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    values = np.zeros((trees, inner + 1))
    offsets = np.arange(width) * BINS
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        bounds, worth = {0: (-np.inf, np.inf)}, {0: 0.0}
        for i in range(inner):
            low, high = bounds[i]
            rows = np.flatnonzero(node == i)
            found = None
            if len(rows):
                flat = (binned[rows] + offsets).ravel()
                hist = [np.bincount(flat, np.repeat(w[rows], width), width * BINS).reshape(width, BINS) for w in (grad, hess)]
                found = _best_split(*hist, falling, low, high)
                if i == 0:
                    worth[0] = float(-grad.sum() / (hess.sum() + SMOOTH))
            if found is None or found[0] <= 1e-9:  # all rows go left, and the value stays
                left, right, sides = worth[i], worth[i], ((low, high), (low, high))
                node[rows] = 2 * i + 1
            else:
                _, f, b, left, right = found
                features[t, i], thresholds[t, i] = f, edges[f][b] if b < len(edges[f]) else np.inf
                node[rows] = 2 * i + 1 + (binned[rows, f] > b)
                middle = (left + right) / 2
                sides = ((middle, high), (low, middle)) if falling[f] else ((low, high), (low, high))
            for child, value, side in ((2 * i + 1, left, sides[0]), (2 * i + 2, right, sides[1])):
                worth[child], bounds[child] = float(value), side
        values[t] = RATE * np.array([worth[i] for i in range(inner, 2 * inner + 1)])
        total += values[t][node - inner]
    return Trees(start, features, thresholds, values, depth)


def base_failed() -> Column:
    """Too few words, or over half of them in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def train(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> Trees | None:
    """Trees from the labelled rows of ``stats``: at most ``max_labelled`` of them, those whose ids hash lowest."""
    known = labels.select(labels[id_col].alias("label_id"), labels[label_col].cast("int").alias("label")).filter("label in (0, 1)")
    drawn = common.lowest(stats.join(known, stats["id"] == known["label_id"]), max_labelled, "id", "label")
    rows = drawn.orderBy(F.xxhash64("id"), "id", "label").select("features", "label").toArrow()
    y = rows.column("label").to_numpy().astype(float)
    if len(np.unique(y)) < 2:
        return None
    x = np.array(rows.column("features").to_pylist())
    falling = np.isin(text_stats.FEATURES, FALLING)
    return fit(x, y, falling)


def _scores(model, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("features").flatten().to_numpy()
            score = model.score(flat.reshape(-1, width)) if batch.num_rows else np.zeros(0)
            yield batch.drop_columns(["features"]).append_column("score", pa.array(score))

    return run


def judge(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = 0.5,
    max_labelled: int = MAX_LABELLED,
) -> DataFrame:
    """Per row of ``docs``: ``id``, its counts, ``base_failed``, ``score`` and ``kept``.

    Texts are read once; their statistics are written, and training and scoring start from these.
    """
    stats = cut(text_stats.measured(docs, id_col, text_col))
    trees = train(stats, labels, id_col, label_col, max_labelled)
    counts = ", ".join(f"{c} long" for c in text_stats.COUNTS)
    if trees is None:
        scored = stats.drop("features").withColumn("score", F.lit(1.0))
    else:
        schema = f"id {common.id_type(docs, id_col)}, {counts}, score double"
        scored = stats.mapInArrow(_scores(trees, len(text_stats.FEATURES)), schema)
    return scored.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= threshold)
    )
