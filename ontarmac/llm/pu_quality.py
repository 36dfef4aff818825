"""Quality classifier learned from trusted positives and unlabelled text.

No document is known to be bad: the positives are documents marked good, the unlabelled ones are any web text, good and
bad mixed. A small network over document statistics minimises the non-negative unbiased risk, in which the risk of the bad
ones is that of the unlabelled minus that of the good ones among them, and never counts less than nothing. The share of
good documents among the unlabelled (the class prior) is estimated first, from how much the top scores of a plain
positive-against-unlabelled model are rarer among the unlabelled than among positives held back.

Training takes bounded samples (``max_positive``, ``max_unlabelled``) of rows whose ids hash lowest; scoring covers all.

Defined results: a null text is empty; an empty text is scored as such. Null ids belong to no fold, are not held out and
carry no label. Without positives or unlabelled rows every document scores 0.5. Rows repeated get equal scores. An
empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ontarmac.llm import common, text_stats
from ontarmac.session import cut

MAX_POSITIVE = 20_000
MAX_UNLABELLED = 40_000
FOLDS, HELD_OUT = 3, 1
HIDDEN, EPOCHS, BATCHES, RATE, DECAY = 16, 60, 20, 0.01, 1e-4
SEED = 17


@dataclass
class Network:
    """Standardisation, one hidden layer, one output; positive outputs mean good."""

    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]

    def prepared(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def output(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh(self.prepared(x) @ w1 + b1) @ w2 + b2[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.output(x), -50, 50)))


def _untrained(x: np.ndarray, rng: np.random.Generator) -> Network:
    scale = x.std(axis=0)
    width = x.shape[1]
    layers = [rng.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    return Network(x.mean(axis=0), np.where(scale > 1e-9, scale, 1.0), layers)


def _descend(net: Network, positive: np.ndarray, unlabelled: np.ndarray, slope, rng: np.random.Generator, epochs: int) -> None:
    """Adam over mini-batches; ``slope`` gives the risk's derivative by the outputs of both parts of a batch."""
    xp, xu = net.prepared(positive), net.prepared(unlabelled)
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in net.layers]
    step = 0
    for _ in range(epochs):
        parts = zip(np.array_split(rng.permutation(len(xp)), BATCHES), np.array_split(rng.permutation(len(xu)), BATCHES))
        for p, u in parts:
            if not len(p) or not len(u):
                continue
            x = np.concatenate([xp[p], xu[u]])
            w1, b1, w2, b2 = net.layers
            hidden = np.tanh(x @ w1 + b1)
            out = hidden @ w2 + b2[0]
            d = np.concatenate(slope(out[: len(p)], out[len(p) :]))
            back = np.outer(d, w2) * (1 - hidden**2)
            grads = [x.T @ back + DECAY * w1, back.sum(axis=0), hidden.T @ d + DECAY * w2, d.sum(keepdims=True)]
            step += 1
            for w, g, (m, v) in zip(net.layers, grads, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _plain_slope(out_p: np.ndarray, out_u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logistic loss of positives against unlabelled, both weighing half."""
    return -0.5 * _sigmoid(-out_p) / len(out_p), 0.5 * _sigmoid(out_u) / len(out_u)


def nn_slope(prior: float):
    """The non-negative unbiased risk with the logistic loss.

    ``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))``. Where the second part falls below zero its gradient is
    reversed, which takes back what was fitted too far.
    """

    def slope(out_p: np.ndarray, out_u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        negative = np.logaddexp(0, out_u).mean() - prior * np.logaddexp(0, out_p).mean()
        d_pos = -prior * _sigmoid(-out_p) / len(out_p)
        as_bad_p = -prior * _sigmoid(out_p) / len(out_p)
        as_bad_u = _sigmoid(out_u) / len(out_u)
        if negative < 0:
            return -as_bad_p, -as_bad_u
        return d_pos + as_bad_p, as_bad_u

    return slope


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, from scores of both that the scoring model was not fitted on.

    Over a threshold above which hardly any bad document scores, the unlabelled are thinner than the positives by just
    that share. The threshold with the lowest upper bound of the ratio is taken.
    """
    cuts = np.unique(np.quantile(positive, np.linspace(0, 0.98, 99)))
    p = np.array([(positive >= c).mean() for c in cuts])
    u = np.array([(unlabelled >= c).mean() for c in cuts])
    slack = np.sqrt(np.log(4 / 0.1) / 2) * (len(unlabelled) ** -0.5 + len(positive) ** -0.5)
    best = np.argmin((u + slack) / np.maximum(p, 1e-9))
    return float(np.clip(u[best] / p[best], 0.01, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, seed: int = SEED, epochs: int = EPOCHS) -> tuple[Network, float]:
    """The network of least non-negative risk and the class prior it was given."""
    rng = np.random.default_rng(seed)
    sides = [(x[rng.random(len(x)) < 0.5], x) for x in (positive, unlabelled)]
    fitted = [half if len(half) else x for half, x in sides]
    plain = _untrained(unlabelled, rng)
    _descend(plain, fitted[0], fitted[1], _plain_slope, rng, epochs // 3)
    rng = np.random.default_rng(seed)
    rest = [x[rng.random(len(x)) >= 0.5] for x in (positive, unlabelled)]
    prior = estimate_prior(*(plain.output(r if len(r) else x) for r, x in zip(rest, (positive, unlabelled))))
    net = _untrained(unlabelled, rng)
    _descend(net, positive, unlabelled, nn_slope(prior), rng, epochs)
    return net, prior


# --- on documents ----------------------------------------------------------------------------------


def fold(id_col: str | Column, folds: int = FOLDS) -> Column:
    """Remainder of the CRC-32 of the id as text; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_positive: int = MAX_POSITIVE,
    max_unlabelled: int = MAX_UNLABELLED,
) -> tuple[Network, float] | None:
    """Fit on rows outside the held-out fold: those labelled 1 against a sample of all.

    The ids are drawn first, and of their rows (an id may have many) at most ``max_positive + max_unlabelled``; only the texts of these
    are measured, and no more reach the driver.
    """
    good = labels.filter(labels[label_col] == 1).select(labels[id_col].alias("label_id"))
    ids = cut(docs.select(docs[id_col].alias("id")).filter(fold("id") != HELD_OUT).distinct())
    positive = common.lowest(ids.join(good, ids["id"] == good["label_id"], "left_semi"), max_positive, "id")
    drawn = cut(
        positive.withColumn("good", F.lit(True)).unionByName(common.lowest(ids, max_unlabelled, "id").withColumn("good", F.lit(False)))
    )
    wanted = F.broadcast(drawn.select(F.col("id").alias("drawn_id")).distinct())
    rows = docs.join(wanted, docs[id_col] == F.col("drawn_id"), "left_semi").select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    bound = max_positive + max_unlabelled
    if rows.count() > bound:  # ids have several rows: equal ones count once, and of the others some are drawn
        marked = rows.withColumn("digest", common.text_digest(rows["text"]))
        chosen = cut(common.lowest(marked.select("id", "digest").distinct(), bound, "id", "digest"))
        rows = marked.join(F.broadcast(chosen), ["id", "digest"], "left_semi").groupBy("id", "digest").agg(F.any_value("text").alias("text"))
    stats = cut(text_stats.measured(rows, "id", "text").select("id", "features"))
    table = common.lowest(stats.join(drawn, "id"), bound, "id", "good", "features")
    table = table.orderBy("id", "good", "features").select("features", "good").toArrow()
    x = np.array(table.column("features").to_pylist(), float).reshape(-1, len(text_stats.FEATURES))
    is_good = table.column("good").to_numpy().astype(bool)
    return fit(x[is_good], x[~is_good]) if is_good.any() and not is_good.all() else None


def _scores(model: Network, texts: list[str]) -> np.ndarray:
    rows = [text_stats.measure(t)[1] for t in texts]
    return model.score(np.array(rows, float).reshape(-1, len(text_stats.FEATURES)))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_positive: int = MAX_POSITIVE,
    max_unlabelled: int = MAX_UNLABELLED,
) -> DataFrame:
    """Per row of ``docs``: ``id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 for good); map-only once trained."""
    model = train(docs, labels, id_col, text_col, label_col, max_positive, max_unlabelled)
    rows = common.two_columns(docs, id_col, text_col)
    if model is None:
        scored = rows.select("id", F.lit(0.5).alias("score"))
    else:

        def of(texts: list[str]) -> dict[str, list]:
            return {"score": _scores(model[0], texts)}

        scored = rows.mapInArrow(common.per_text(of, {"score": pa.float64()}), f"id {common.id_type(docs, id_col)}, score double")
    return scored.select(
        "id",
        F.coalesce(fold("id") == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings
) -> DataFrame:
    """``docs`` without the documents classified as bad; all columns kept. The texts do not move."""
    model = train(docs, labels, id_col, text_col, **settings)
    if model is None:
        return docs

    def good(texts: pd.Series) -> pd.Series:
        return pd.Series(_scores(model[0], texts.tolist()) >= 0.5)

    return docs.filter(F.pandas_udf(good, "boolean")(F.coalesce(docs[text_col].cast("string"), F.lit(""))))
