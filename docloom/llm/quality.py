"""Quality: naive Bayes support vectors over n-gram indicators.

An indicator says that a text holds an n-gram: of three bytes, or of two neighbouring words' shapes (kind of first and last
letter, length, and whether the word repeats the one before). Each is scaled by its log-count ratio of the classes, the
vector brought to length 1, and a linear model with hinge loss fitted by dual coordinate descent, errors in the rarer
class weighing more. A part of the labelled rows that the descent does not see sets the threshold; the score is the logistic of the
distance to it.

The sample to learn from is bounded (`most_rows`, `most_bytes`); every text is scored whole. Defined results: a null or
empty text has no n-grams and gets the score of the bias alone; without labels of both classes the score is 0, or 1 if all
labels are 1; repeated rows score alike; an empty table gives none; other columns
pass through, but for names that start with `_quality_`, which are the operator's own and replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.arrow import appended
from docloom.llm.common import own, tidy
from docloom.llm.labelled import fold, sample
from docloom.llm.textvec import Texts, hashed, pieces

BITS = 17
HALF = 1 << (BITS - 1)
#: Texts whose indicators are marked in one array of GROUP * 2**BITS bytes.
GROUP = 128
_KIND = np.zeros(256, np.int64)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 1, 2, 3, 4


def indicators(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of text and n-gram, each once, in order of the text."""
    docs, grams = [], []
    for i in range(0, len(texts), GROUP):
        at = texts.offsets[i : i + GROUP + 1]
        d, g = _some(Texts(texts.data[at[0] : at[-1]], at - at[0]))
        docs.append(d + i)
        grams.append(g)
    none = np.zeros(0, np.int64)
    return (np.concatenate(docs), np.concatenate(grams)) if docs else (none, none)


def _some(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    data, at, n = texts.data, texts.offsets, len(texts)
    marked = np.zeros(n << BITS, bool)
    if len(data) > 2:
        doc = np.repeat(np.arange(n), np.diff(at))
        x = data.astype(np.int64)
        key = (x[:-2] * 40503 + x[1:-1] * 2531 + x[2:] * 157) & (HALF - 1)
        marked[(doc[:-2] << BITS | key)[doc[:-2] == doc[2:]]] = True
    starts, ends, first = texts.words()
    if len(starts) > 1:
        h = hashed(texts.sums(), starts, ends)
        again = np.concatenate([[0], h[1:] == h[:-1]]).astype(np.int64)
        shape = ((_KIND[data[starts]] * 5 + _KIND[data[ends - 1]]) * 12 + np.minimum(ends - starts, 11)) * 2 + again
        doc = np.repeat(np.arange(n), np.diff(first))
        key = HALF + ((shape[:-1] * 761 + shape[1:]) & (HALF - 1))
        marked[(doc[:-1] << BITS | key)[doc[:-1] == doc[1:]]] = True
    found = np.flatnonzero(marked)
    return found >> BITS, found & ((1 << BITS) - 1)


@dataclass
class Model:
    weight: np.ndarray  # of each indicator, its ratio included
    square: np.ndarray  # of its ratio
    bias: float
    limit: float = 0.0
    slope: float = 4.0
    constant: float | None = None

    def margins(self, docs: np.ndarray, grams: np.ndarray, n: int) -> np.ndarray:
        length = np.sqrt(np.maximum(np.bincount(docs, self.square[grams], n), 1e-12))
        return np.bincount(docs, self.weight[grams], n) / length + self.bias

    def score(self, texts: Texts) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        z = self.slope * (self.margins(*indicators(texts), len(texts)) - self.limit)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def descend(rows: list[np.ndarray], values: list[np.ndarray], sign: np.ndarray, cost: np.ndarray, size: int, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Weights and bias of least hinge loss, by dual coordinate descent: each step solves one row's dual variable exactly."""
    rng = np.random.default_rng(seed)
    w, bias, dual = np.zeros(size), 0.0, np.zeros(len(rows))
    curve = np.array([float(v @ v) + 1 for v in values])
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            slack = sign[i] * (w[rows[i]] @ values[i] + bias) - 1
            new = min(max(dual[i] - slack / curve[i], 0.0), cost[i])
            if new != dual[i]:
                step = (new - dual[i]) * sign[i]
                w[rows[i]] += step * values[i]
                bias += step
                dual[i] = new
    return w, bias


def train(texts: list[str], y: list[int], epochs: int = 15, cost: float = 1.0, seed: int = 5) -> Model:
    """Fit on four fifths of the texts, set the threshold on the rest."""
    y = np.array(y)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(1), np.zeros(1), 0.0, constant=float(len(y) and y[0]))
    raw = [t.encode("utf-8", "replace") for t in texts]
    docs, grams = indicators(Texts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])))
    order = np.random.default_rng(seed).permutation(len(y))
    held, fit = order[: len(y) // 5], order[len(y) // 5 :]
    if y[fit].min() == y[fit].max():
        fit = order
    fits = np.zeros(len(y), bool)
    fits[fit] = True
    count = [np.bincount(grams[fits[docs] & (y[docs] == c)], minlength=1 << BITS) + 1.0 for c in (1, 0)]
    ratio = np.log((count[0] / count[0].sum()) / (count[1] / count[1].sum()))
    at = np.searchsorted(docs, np.arange(len(y) + 1))
    rows = [grams[at[i] : at[i + 1]] for i in fit]
    values = [ratio[r] / max(1e-6, np.sqrt(ratio[r] @ ratio[r])) for r in rows]
    share = y[fit].mean()
    costs = cost * np.where(y[fit] == 1, 0.5 / share, 0.5 / (1 - share))
    w, bias = descend(rows, values, np.where(y[fit] == 1, 1.0, -1.0), costs, 1 << BITS, epochs, seed)
    model = Model((w * ratio), ratio**2, bias)
    z = model.margins(docs, grams, len(y))
    rest = held if len(held) and y[held].min() != y[held].max() else order
    model.limit = _limit(z[rest], y[rest])
    return model


def _limit(z: np.ndarray, y: np.ndarray) -> float:
    """The threshold with the best mean recall of both classes, nearest to 0."""
    cuts = np.unique(z)
    cuts = np.concatenate([[0.0], (cuts[1:] + cuts[:-1]) / 2]) if len(cuts) > 1 else np.zeros(1)
    up, down = np.sort(z[y == 1]), np.sort(z[y == 0])
    good = (len(up) - np.searchsorted(up, cuts)) / len(up) + np.searchsorted(down, cuts) / len(down)
    best = cuts[good >= good.max() - 1e-9]
    return float(best[np.argmin(np.abs(best))])


def fit(docs: DataFrame, labels: DataFrame, most_rows: int = 4000, most_bytes: int = 65536) -> Model:
    return train(*sample(docs, labels, "quality", fold(F.col("doc_id"), 3) != 1, most_rows, most_bytes))


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with `_quality_score`. The model (2 MB, whatever the corpus) is broadcast."""
    docs = own(docs, "_quality_")
    shared, names = docs.sparkSession.sparkContext.broadcast(model), docs.columns
    at = names.index("text")

    def run(batches):
        for batch in batches:
            scores = [shared.value.score(t) for _, _, t in pieces(batch.column(at), 1 << 20)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(scores) if scores else np.zeros(0))], names=[*names, "_quality_score"])

    return docs.mapInArrow(tidy(run), appended(docs, "_quality_score double"))


def op4_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's view."""
    out = score_quality(docs.select("doc_id", "text"), fit(docs, labels))
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), F.col("_quality_score").alias("score"), (F.col("_quality_score") >= 0.5).cast("int").alias("predicted"))
