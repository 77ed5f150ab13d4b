"""Toxicity by a convolutional network over words, trained in numpy.

Words are hashed to embeddings; filters of several widths run over them and are max-pooled over the whole
text; a logistic layer combines the pooled filters. A filter's value is a sum of one table entry per word it
covers, so scoring looks tables up and needs no multiplication. Texts are cut into overlapping segments and
pooled again, so memory doesn't grow with a text. Decision thresholds are calibrated by language on documents
the network didn't learn from; the score itself sees the text alone.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantmetrics.llm.arrow import begin_task, map_columns
from plantmetrics.llm.labelled import Adagrad, all_labelled, fold, sigmoid, train_by_parts
from plantmetrics.sources import scratch_scope, stage

WORD = re.compile(r"\w+")
SEGMENT = 4096
#: Words of a text that training looks at together.
LONG = 65_536
#: Steps of the scores that thresholds lie between.
STEPS = 1 << 16
CACHE_WORDS = 300_000


@dataclass(frozen=True)
class ToxicitySettings:
    buckets: int = 1 << 15
    dimensions: int = 12
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 12
    epochs: int = 8
    rate: float = 0.08
    decay: float = 1e-5
    #: Documents that a task learns from in a round.
    per_part: int = 2500
    #: The learning fold that thresholds are calibrated on, and documents of either label that a language
    #: needs there for a threshold of its own.
    calibration_fold: int = 1
    min_calibration: int = 15
    seed: int = 7


class _Ids(dict):
    """Word -> row of the embedding table; row 0 is the blank."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = row = 1 + xxhash.xxh32_intdigest(word) % (self.buckets - 1)
        return row


def word_ids(text: str | None, ids: _Ids) -> np.ndarray:
    found = WORD.findall((text or "").lower())
    return np.fromiter(map(ids.__getitem__, found), np.int32, len(found))


@dataclass
class ToxicityModel:
    settings: ToxicitySettings
    parameters: dict[str, np.ndarray]
    thresholds: dict[str, float] = field(default_factory=dict)

    def tables(self) -> dict[tuple[int, int], np.ndarray]:
        """(width, offset) -> what a word at this offset of a filter adds to it."""
        p, d = self.parameters, self.settings.dimensions
        return {
            (w, k): np.ascontiguousarray(p["words"] @ p[f"w{w}"][k * d : (k + 1) * d])
            for w in self.settings.widths
            for k in range(w)
        }

    def score(self, texts: list[np.ndarray], tables) -> np.ndarray:
        """Probabilities of texts given as word rows; texts of any length."""
        most, segments, owner = max(self.settings.widths) - 1, [], []
        for k, text in enumerate(texts):
            for start in range(0, max(1, len(text)), SEGMENT):
                segments.append(text[start : start + SEGMENT + most])
                owner.append(k)
        pooled, at = [], 0
        while at < len(segments):  # some segments at a time
            stop, size = at, 0
            while stop < len(segments) and size < 16 * SEGMENT:
                size += len(segments[stop]) + most + 1
                stop += 1
            pooled.append(self._pool(segments[at:stop], tables))
            at = stop
        if not segments:
            return np.empty(0)
        starts = np.searchsorted(np.array(owner), np.arange(len(texts)))
        pooled = np.maximum.reduceat(np.concatenate(pooled), starts, axis=0)
        p = self.parameters
        return sigmoid(np.maximum(pooled, 0) @ p["out"] + p["bias"][0])

    def _pool(self, segments, tables) -> np.ndarray:
        most = max(self.settings.widths) - 1
        blank = np.zeros(most + 1, np.int32)
        flat = np.concatenate([piece for one in segments for piece in (one, blank)])
        stops = np.cumsum([len(one) + most + 1 for one in segments])
        starts = np.concatenate([[0], stops[:-1]])
        pooled = []
        for w in self.settings.widths:
            size = len(flat) - w + 1
            value = tables[w, 0][flat[:size]]
            for k in range(1, w):
                value += tables[w, k][flat[k : k + size]]
            # windows that end behind a segment's own blanks reach into the next text: they stay out
            bounds = np.column_stack([starts, stops - w + 1]).ravel()[:-1]
            pooled.append(np.maximum.reduceat(value, bounds, axis=0)[::2] + self.parameters[f"b{w}"])
        return np.concatenate(pooled, axis=1)


def new_model(settings: ToxicitySettings) -> ToxicityModel:
    rng = np.random.default_rng(settings.seed)
    d, f, widths = settings.dimensions, settings.filters, settings.widths
    p = {"words": rng.normal(0, 0.1, (settings.buckets, d)).astype(np.float32)}
    p["words"][0] = 0
    for w in widths:
        p[f"w{w}"] = rng.normal(0, 1 / np.sqrt(w * d), (w * d, f)).astype(np.float32)
        p[f"b{w}"] = np.zeros(f, np.float32)
    p["out"] = rng.normal(0, 0.3, f * len(widths)).astype(np.float32)
    p["bias"] = np.zeros(1, np.float32)
    return ToxicityModel(settings, p)


def _condensed(text: np.ndarray, p: dict[str, np.ndarray], settings: ToxicitySettings) -> np.ndarray:
    """A text of more than ``LONG`` words as the windows that are the best of a filter in some stretch of it, with
    blanks between: the whole text is looked at, and its best windows are among them."""
    if len(text) <= LONG:
        return text
    d, most, kept = settings.dimensions, max(settings.widths) - 1, []
    for start in range(0, len(text), LONG):
        stretch = text[start : start + LONG + most]
        vectors = p["words"][stretch]
        for w in settings.widths:
            size = len(stretch) - w + 1
            if size > 0:
                value = sum(vectors[k : k + size] @ p[f"w{w}"][k * d : (k + 1) * d] for k in range(w))
                windows = stretch[np.unique(value.argmax(axis=0))[:, None] + np.arange(w)]
                kept.append(np.pad(windows, ((0, 0), (0, most))).ravel())
    return np.concatenate(kept)


def learn(optimiser: Adagrad, texts: list[bytes], labels: np.ndarray, rng, settings: ToxicitySettings) -> None:
    """Go once through texts given as word rows, 16 together."""
    blank = np.zeros(max(settings.widths), np.int32)
    order = rng.permutation(len(texts))
    for at in range(0, len(order), 16):
        some = order[at : at + 16]
        words = [_condensed(np.frombuffer(texts[k], np.int32), optimiser.p, settings) for k in some]
        _step(optimiser, [np.concatenate([one, blank]) for one in words], labels[some], settings)


def _step(optimiser: Adagrad, texts: list[np.ndarray], labels: np.ndarray, settings: ToxicitySettings) -> None:
    p, d, f = optimiser.p, settings.dimensions, settings.filters
    flat = np.concatenate(texts)
    ends = np.cumsum([len(one) for one in texts])
    vectors = p["words"][flat]
    best, top = [], []
    for w in settings.widths:
        size = len(flat) - w + 1
        value = sum(vectors[k : k + size] @ p[f"w{w}"][k * d : (k + 1) * d] for k in range(w))
        starts = ends - [len(one) for one in texts]
        own = np.array([a + value[a : b - w + 1].argmax(axis=0) for a, b in zip(starts, ends, strict=True)])
        best.append(own)
        top.append(np.take_along_axis(value, own, axis=0) + p[f"b{w}"])
    pooled = np.maximum(np.concatenate(top, axis=1), 0)
    error = ((sigmoid(pooled @ p["out"] + p["bias"]) - labels) / len(texts)).astype(np.float32)
    down = np.outer(error, p["out"]) * (pooled > 0)
    optimiser.step("out", pooled.T @ error)
    optimiser.step("bias", error.sum(keepdims=True))
    rows, slopes = [], []
    for k, (w, own) in enumerate(zip(settings.widths, best, strict=True)):
        own_down = down[:, k * f : (k + 1) * f]
        gradient = np.zeros_like(p[f"w{w}"])
        for offset in range(w):
            part = p[f"w{w}"][offset * d : (offset + 1) * d]
            gradient[offset * d : (offset + 1) * d] = np.einsum("nf,nfd->df", own_down, vectors[own + offset])
            rows.append(flat[own + offset].ravel())
            slopes.append((own_down[:, :, None] * part.T[None]).reshape(-1, d))
        optimiser.step(f"w{w}", gradient)
        optimiser.step(f"b{w}", own_down.sum(axis=0))
    touched, place = np.unique(np.concatenate(rows), return_inverse=True)
    gradient = np.zeros((len(touched), d), np.float32)
    np.add.at(gradient, place, np.concatenate(slopes))
    optimiser.step("words", gradient[touched > 0], touched[touched > 0])


def best_threshold(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The middle of the gap between scores that gives the best weighted F1, nearest 0.5 among equals."""
    order = np.argsort(-scores)
    scores, hits, taken = scores[order], np.cumsum((labels * weights)[order]), np.cumsum(weights[order])
    f1 = 2 * hits / (taken + hits[-1])
    cuts = (scores + np.append(scores[1:], 0.0)) / 2
    f1[:-1][scores[:-1] == scores[1:]] = -1
    best = np.flatnonzero(f1 >= f1.max() - 1e-9)
    return float(cuts[best[np.argmin(np.abs(cuts[best] - 0.5))]])


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, settings: ToxicitySettings = ToxicitySettings(), label: str = "toxic"
) -> ToxicityModel:
    """Learn from all labelled documents of the learning folds (see ``train_by_parts``) but one fold, whose documents
    all calibrate the thresholds: scores are counted in ``STEPS`` steps, and thresholds lie between steps.

    With labels of one kind only, or none, the model still scores. A language with fewer than ``min_calibration``
    calibration documents of either label takes the threshold of all languages together, and that is 0.5 if they
    have too few as well.
    """
    rows = all_labelled(docs, labels, label).withColumn("fold", fold("doc_id"))
    buckets = settings.buckets

    def ids(doc_ids, texts, langs, ys, folds):
        known = _Ids(buckets)
        return doc_ids, [word_ids(text, known).tobytes() for text in texts], langs, ys, folds

    rows = rows.select("doc_id", "text", "lang", "y", "fold")
    with scratch_scope(docs.sparkSession):  # the model needs no table any more
        found = stage(map_columns(rows, ids, "doc_id long, data binary, lang string, y int, fold long"), "toxicity-words")
        model = new_model(settings)
        held = F.col("fold") == settings.calibration_fold
        train_by_parts(
            found.where(~held), model.parameters, lambda optimiser, texts, ys, rng: learn(optimiser, texts, ys, rng, settings), settings
        )
        shared = docs.sparkSession.sparkContext.broadcast((model, model.tables()))

        def steps(data, langs, ys):
            own, tables = shared.value
            scores = []
            for at in range(0, len(data), 256):
                scores.append(own.score([np.frombuffer(one, np.int32) for one in data[at : at + 256]], tables))
            step = np.minimum(STEPS - 1, np.floor(np.concatenate(scores) * STEPS)).astype(np.int64)
            return [("", one) if one else ("",) for one in langs], step.tolist(), ys

        scored = map_columns(found.where(held).select("data", "lang", "y"), steps, "langs array<string>, step long, y int")
        counted = scored.select(F.explode("langs").alias("lang"), "step", "y").groupBy("lang", "step", "y").count()

        def threshold(group):
            import pandas as pd

            ys, n = group["y"].to_numpy(np.float64), group["count"].to_numpy(np.float64)
            enough = min((ys * n).sum(), ((1 - ys) * n).sum()) >= settings.min_calibration
            best = best_threshold((group["step"].to_numpy() + 0.5) / STEPS, ys, n) if enough else float("nan")
            return pd.DataFrame({"lang": group["lang"].iloc[:1], "cut": [best]})

        cuts = counted.groupBy("lang").applyInPandas(threshold, "lang string, cut double").where("cut IS NOT NULL AND NOT isnan(cut)")
        model.thresholds = dict(sorted((row["lang"], row["cut"]) for row in cuts.collect()))
    return model


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, names: tuple[str, str] = ("_score", "_toxic")
) -> DataFrame:
    """``docs`` plus, by the two ``names``, a score (double) and whether it reaches the threshold of the language.

    A null text counts as empty and gets the score of no words. Rows are independent and every row is kept;
    a null or unknown language takes the common threshold. Other columns pass through untouched, except
    that columns of these names are replaced. An empty table gives an empty result.
    """
    from pyspark.sql.functions import pandas_udf

    context = docs.sparkSession.sparkContext
    shared = context.broadcast((model, model.tables()))  # fixed size: buckets x filters x the sum of widths
    buckets = model.settings.buckets

    @pandas_udf("double")
    def score(text):
        import pandas as pd

        begin_task()
        own, tables = shared.value
        known, result = _Ids(buckets), []
        texts = text.tolist()
        for at in range(0, len(texts), 256):
            result.append(own.score([word_ids(one, known) for one in texts[at : at + 256]], tables))
        return pd.Series(np.concatenate(result) if result else [], dtype="float64")

    common = model.thresholds.get("", 0.5)
    pairs = [F.lit(x) for item in model.thresholds.items() if item[0] for x in item]
    threshold = F.coalesce(F.element_at(F.create_map(*pairs), F.col("lang")), F.lit(common)) if pairs else F.lit(common)
    return docs.withColumn(names[0], score(F.col("text"))).withColumn(names[1], F.col(names[0]) >= threshold)
