"""Document quality by a convolutional network over bytes, trained in numpy.

Bytes have embeddings; learned filters eight bytes wide run over the whole text at every fourth byte. The text
is cut into overlapping chunks (each of two blocks, the next one begins a block later); a filter is max-pooled
in each chunk. The mean and the maximum over chunks go through a small hidden layer into one probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantmetrics.llm.arrow import map_columns
from plantmetrics.llm.labelled import Adagrad, all_labelled, sigmoid, train_by_parts
from plantmetrics.sources import stage

STRIDE = 4
#: Steps of log odds, a unit, that calibration counts.
STEPS = 20


@dataclass(frozen=True)
class QualitySettings:
    dimensions: int = 8
    filters: int = 32
    hidden: int = 16
    #: Filter positions in a block; a chunk is two blocks, so 2 * 128 * STRIDE = 1,024 bytes.
    block: int = 128
    epochs: int = 12
    rate: float = 0.05
    decay: float = 1e-5
    #: Documents that a task learns from in a round.
    per_part: int = 4000
    seed: int = 11


def _cells(data: bytes) -> np.ndarray:
    """The bytes as rows of ``STRIDE``, filled up with zeros; two rows at least, for one filter position."""
    size = max(2, -(-len(data) // STRIDE))
    return np.frombuffer(data.ljust(size * STRIDE, b"\0"), np.uint8).reshape(size, STRIDE)


@dataclass
class QualityModel:
    settings: QualitySettings
    parameters: dict[str, np.ndarray]
    scale: float = 1.0
    shift: float = 0.0

    def blocks(self, cells: np.ndarray) -> np.ndarray:
        """Maxima of the filters in each block of positions."""
        value = self._values(cells)
        return np.maximum.reduceat(value, np.arange(0, len(value), self.settings.block), axis=0)

    def _values(self, cells: np.ndarray) -> np.ndarray:
        p, f = self.parameters, self.settings.filters
        both = p["bytes"][cells].reshape(len(cells), -1) @ p["both"]  # both halves of a filter at each cell
        return both[:-1, :f] + both[1:, f:]

    def features(self, data: bytes) -> np.ndarray:
        """Mean and maximum of the chunks' pooled filters; a long text is worked through in pieces."""
        p, step = self.parameters, self.settings.block * 512
        cells, maxima = _cells(data), []
        for start in range(0, len(cells) - 1, step):  # a position needs the cell after it as well
            maxima.append(self.blocks(cells[start : start + step + 1]))
        maxima = np.concatenate(maxima)
        chunks = np.maximum(maxima[:-1], maxima[1:]) if len(maxima) > 1 else maxima
        chunks = np.maximum(chunks + p["offset"], 0)
        return np.concatenate([chunks.mean(axis=0), chunks.max(axis=0)])

    def score(self, texts: list[bytes]) -> np.ndarray:
        p = self.parameters
        if not texts:
            return np.empty(0)
        features = np.array([self.features(one) for one in texts])
        hidden = np.tanh(features @ p["hidden"] + p["h_bias"])
        return sigmoid(self.scale * (hidden @ p["out"] + p["bias"][0]) + self.shift)


def new_model(settings: QualitySettings) -> QualityModel:
    rng = np.random.default_rng(settings.seed)
    d, f, h = settings.dimensions, settings.filters, settings.hidden
    sizes = {"bytes": (256, d, 0.5), "both": (STRIDE * d, 2 * f, 0.25), "hidden": (2 * f, h, 0.2)}
    p = {name: rng.normal(0, s, (a, b)).astype(np.float32) for name, (a, b, s) in sizes.items()}
    p |= {"offset": np.zeros(f, np.float32), "h_bias": np.zeros(h, np.float32)}
    p |= {"out": rng.normal(0, 0.3, h).astype(np.float32), "bias": np.zeros(1, np.float32)}
    return QualityModel(settings, p)


def learn(optimiser: Adagrad, texts: list[bytes], labels: np.ndarray, rng, settings: QualitySettings, weights) -> None:
    """Go once through whole texts, 16 together; ``weights`` of label 0 and of label 1."""
    model, order = QualityModel(settings, optimiser.p), rng.permutation(len(texts))
    for at in range(0, len(order), 16):
        some = order[at : at + 16]
        _step(model, optimiser, [_cells(texts[k]) for k in some], labels[some], weights)


def _pool(model: QualityModel, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(maximum, its position) of each filter in each chunk of a text; a long text is worked through in pieces."""
    block, own, top = model.settings.block, [], []
    for start in range(0, len(cells) - 1, block * 512):
        value = model._values(cells[start : start + block * 512 + 1])
        best = np.array([a + value[a : a + block].argmax(axis=0) for a in range(0, len(value), block)])
        top.append(np.take_along_axis(value, best, axis=0))
        own.append(best + start)
    own, top = np.concatenate(own), np.concatenate(top)
    if len(top) == 1:
        return top, own
    later = top[1:] > top[:-1]
    return np.where(later, top[1:], top[:-1]), np.where(later, own[1:], own[:-1])


def _step(model: QualityModel, optimiser: Adagrad, texts: list[np.ndarray], labels: np.ndarray, weights=(1.0, 1.0)) -> None:
    p, f, d = model.parameters, model.settings.filters, model.settings.dimensions
    pools = [_pool(model, cells) for cells in texts]
    chunks = [np.maximum(top + p["offset"], 0) for top, _ in pools]
    features = np.array([np.concatenate([one.mean(axis=0), one.max(axis=0)]) for one in chunks])
    hidden = np.tanh(features @ p["hidden"] + p["h_bias"])
    error = ((sigmoid(hidden @ p["out"] + p["bias"]) - labels) / len(texts) * np.where(labels == 1, weights[1], weights[0])).astype(np.float32)
    down_hidden = np.outer(error, p["out"]) * (1 - hidden**2)
    down = down_hidden @ p["hidden"].T
    both, byte_slopes, offset = np.zeros_like(p["both"]), np.zeros_like(p["bytes"]), np.zeros_like(p["offset"])
    for (_, own), chunk, cells, slope in zip(pools, chunks, texts, down, strict=True):
        slopes = np.repeat(slope[None, :f] / len(chunk), len(chunk), axis=0)
        np.add.at(slopes, (chunk.argmax(axis=0), np.arange(f)), slope[f:])
        slopes = slopes * (chunk > 0)
        offset += slopes.sum(axis=0)
        for half, columns in ((0, slice(0, f)), (1, slice(f, 2 * f))):
            seen = cells[own + half]  # chunks x filters x bytes
            vectors = p["bytes"][seen].reshape(*own.shape, -1)
            both[:, columns] += np.einsum("cf,cfx->xf", slopes, vectors)
            back = (slopes[:, :, None] * p["both"][:, columns].T[None]).reshape(-1, d)
            np.add.at(byte_slopes, seen.ravel(), back)
    optimiser.step("out", hidden.T @ error)
    optimiser.step("bias", error.sum(keepdims=True))
    optimiser.step("hidden", features.T @ down_hidden)
    optimiser.step("h_bias", down_hidden.sum(axis=0))
    optimiser.step("offset", offset)
    optimiser.step("both", both)
    optimiser.step("bytes", byte_slopes)


def fit_quality(
    docs: DataFrame, labels: DataFrame, settings: QualitySettings = QualitySettings(), label: str = "quality"
) -> QualityModel:
    """Learn from all labelled documents of the learning folds (see ``train_by_parts``). With labels of one kind only,
    or none, the model still scores. Both labels weigh the same in learning; the log odds of all these documents,
    counted in steps of 1 / ``STEPS``, then give the scale and shift with which scores are shares of label 1.
    """
    rows = all_labelled(docs, labels, label).select("doc_id", F.encode("text", "UTF-8").alias("data"), "y")
    rows, model = stage(rows, "quality-texts"), new_model(settings)
    totals = {row["y"]: row["count"] for row in rows.groupBy("y").count().collect()}
    weights = (1.0, 1.0)
    if len(totals) == 2:
        weights = tuple(sum(totals.values()) / (2 * totals[y]) for y in (0, 1))
    train_by_parts(
        rows, model.parameters, lambda optimiser, texts, ys, rng: learn(optimiser, texts, ys, rng, settings, weights), settings
    )
    if len(totals) == 2:
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def steps(data, ys):
            scores = np.clip(shared.value.score(data), 1e-9, 1 - 1e-9)
            return np.rint(np.log(scores / (1 - scores)) * STEPS).astype(np.int64).tolist(), ys

        scored = map_columns(rows.select("data", "y"), steps, "step long, y int")
        counted = scored.groupBy("step", "y").count().orderBy("step", "y").toPandas()  # log odds are within 21
        model.scale, model.shift = calibrate(*(counted[name].to_numpy(np.float64) for name in ("step", "y", "count")))
    return model


def calibrate(steps: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """Scale and shift of log odds that fit the labels best (logistic regression by Newton's method); a weak pull
    to 1 and 0 keeps them finite."""
    x = np.column_stack([steps / STEPS, np.ones(len(steps))])
    start = found = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(x @ found)
        slope = x.T @ (counts * (p - labels)) + (found - start)
        bend = (x * (counts * p * (1 - p))[:, None]).T @ x + np.eye(2)
        step = np.linalg.solve(bend, slope)
        found = found - step * min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
    return float(max(found[0], 1e-3)), float(found[1])


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id`` and ``score`` for every row: the probability of label 1 from the whole text.

    A null text counts as empty and gets the score of blank bytes. Rows are independent, repeated rows get
    equal scores, a null doc_id stays null, other columns are ignored, an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some thousand numbers

    def work(ids, texts):
        return ids, shared.value.score([(text or "").encode() for text in texts])

    return map_columns(docs.select(F.col("doc_id").cast("long"), "text"), work, "doc_id long, score double")
