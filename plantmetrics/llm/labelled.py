"""Labelled documents, learning from all of them in parts, and the little that both classifiers share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labels are learned only from documents whose remainder is not 0.
FOLDS = 5


def fold(doc_id) -> Column:
    """crc32 of the id as text, modulo ``FOLDS``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS


def all_labelled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """``doc_id, text, lang, y`` of every labelled document in the learning folds, whatever its length.

    Labels other than 0 and 1 and null ids are ignored; of several labels of a document the largest counts, of
    several rows of a document the largest text.
    """
    known = labels.select(F.col("doc_id").alias("known"), F.col(label).cast("int").alias("y"))
    known = known.where("y IN (0, 1) AND known IS NOT NULL").where(fold("known") != 0)
    known = known.groupBy("known").agg(F.max("y").alias("y"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang")
    joined = texts.join(known, F.col("doc_id") == F.col("known"))
    return joined.groupBy("doc_id").agg(F.max("text").alias("text"), F.max("lang").alias("lang"), F.max("y").alias("y"))


#: Numbers in a block of parameters: tasks' changes are added up block by block.
_BLOCK = 1 << 14


def train_by_parts(
    rows: DataFrame,
    parameters: dict[str, np.ndarray],
    learn: Callable[[Adagrad, Sequence, np.ndarray, np.random.Generator], None],
    settings,
) -> None:
    """Learn ``parameters`` in place from all ``rows`` (``doc_id, data binary, y``), in tasks of some ``per_part`` rows.

    Up to ``per_part`` rows are one part, gone through ``epochs`` times. More are dealt by a hash of the id to slices of
    parts; there is a round for each epoch, which takes the next slice, so that every row is learned from, by more
    tasks the more rows there are. In a round each part goes on from the same parameters and histories, and what it
    changed is averaged over the parts that changed it. The driver sees sums of a fixed size. ``learn`` goes through
    some rows once.
    """
    n = rows.count()
    slices = min(settings.epochs, max(1, n // settings.per_part))
    parts = -(-n // (slices * settings.per_part))
    alone = slices * parts == 1
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(settings.seed)), F.lit(max(1, slices * parts))))
    optimiser = Adagrad(parameters, settings.rate, settings.decay)
    context, names = rows.sparkSession.sparkContext, list(parameters)
    for number in range((1 if alone else settings.epochs) if n else 0):
        shared = context.broadcast((parameters, optimiser.seen))

        def part(group):
            import pandas as pd

            before, seen = shared.value
            own = Adagrad({k: v.copy() for k, v in before.items()}, settings.rate, settings.decay)
            own.seen = {k: v.copy() for k, v in seen.items()}
            group = group.sort_values("doc_id")
            rng = np.random.default_rng([settings.seed, number, int(group["part"].iloc[0])])
            for _ in range(settings.epochs if alone else 1):
                learn(own, group["data"].tolist(), group["y"].to_numpy(np.float32), rng)
            changed = _flat(own.p, names) - _flat(before, names), _flat(own.seen, names) - _flat(seen, names)
            flat = np.concatenate(changed)
            blocks = [flat[at : at + _BLOCK].tobytes() for at in range(0, len(flat), _BLOCK)]
            return pd.DataFrame({"block": range(len(blocks)), "change": blocks})

        def mean(group):
            import pandas as pd

            changes = (np.frombuffer(one, np.float32) for one in group["change"])
            total = count = 0
            for one in changes:
                total, count = total + one.astype(np.float64), count + (one != 0)
            return pd.DataFrame({"block": group["block"].iloc[:1], "change": [(total / np.maximum(count, 1)).astype(np.float32).tobytes()]})

        kind = "block int, change binary"
        here = dealt.where(F.col("part") % slices == number % slices)
        changes = here.groupBy("part").applyInPandas(part, kind)
        if not alone:
            changes = changes.groupBy("block").applyInPandas(mean, kind)
        found = sorted((row["block"], row["change"]) for row in changes.collect())
        if not found:  # no row was dealt to this slice
            continue
        flat, at = np.concatenate([np.frombuffer(change, np.float32) for _, change in found]), 0
        for table in (parameters, optimiser.seen):
            for name in names:
                size = table[name].size
                table[name] += flat[at : at + size].reshape(table[name].shape)
                at += size
        shared.unpersist()


def _flat(tables: dict[str, np.ndarray], names: Sequence[str]) -> np.ndarray:
    return np.concatenate([tables[name].ravel() for name in names])


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Adagrad:
    """Parameters by name, each updated by its own gradient history."""

    def __init__(self, parameters: dict[str, np.ndarray], rate: float, decay: float = 0.0):
        self.p, self.rate, self.decay = parameters, rate, decay
        self.seen = {name: np.full_like(value, 1e-6) for name, value in parameters.items()}

    def step(self, name: str, gradient: np.ndarray, rows: np.ndarray | None = None) -> None:
        """``rows``: distinct rows of the parameter that the gradient is for; all by default."""
        at = slice(None) if rows is None else rows
        if self.decay:
            gradient = gradient + self.decay * self.p[name][at]
        self.seen[name][at] += gradient * gradient
        self.p[name][at] -= self.rate * gradient / np.sqrt(self.seen[name][at])
