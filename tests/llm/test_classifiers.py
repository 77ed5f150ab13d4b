import numpy as np
import pytest
from pyspark.sql import functions as F

from plantmetrics.llm.labelled import all_labelled, fold, train_by_parts
from plantmetrics.llm.quality import STEPS, QualitySettings, calibrate, fit_quality, score_quality
from plantmetrics.llm.queries import QUERIES
from plantmetrics.llm.toxicity import ToxicityModel, ToxicitySettings, best_threshold, fit_toxicity, score_toxicity

SF = "/root/testdata/sf0.1"
LABELS = "doc_id long, toxic int, quality int"


@pytest.mark.parametrize(("query", "label", "least"), [("op3_toxicity", "toxic", 0.88), ("op10_quality", "quality", 0.97)])
def test_held_out_ranking(spark, query, label, least):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", label)
    rows = QUERIES[query](spark, SF).join(labels, "doc_id").where("held_out").toPandas()
    assert rows["score"].between(0, 1).all()
    ranks = rows["score"].rank()
    ones = rows[label] == 1
    area = (ranks[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())
    assert area > least
    assert (rows["predicted"] == rows[label]).mean() > 0.93


def test_long_and_odd_texts(spark, documents):
    docs = documents([(k, f"fine words {k} here") for k in range(30)] + [(k + 30, f"bad awful {k}") for k in range(30)])
    labels = spark.createDataFrame([(k, int(k >= 30), int(k < 30)) for k in range(60)] + [(None, 1, 1), (5, None, 7)], LABELS)
    odd = documents([(1, None), (1, ""), (None, "awful"), (7, "word " * 200_000 + "awful"), (8, "word " * 200_000)])
    model = fit_toxicity(docs, labels, ToxicitySettings(buckets=256, epochs=30))
    rows = score_toxicity(odd.withColumnRenamed("n_chars", "_score"), model).collect()
    assert [r.doc_id for r in rows] == [1, 1, None, 7, 8] and rows[0]._score == rows[1]._score
    assert rows[3]._score > rows[4]._score and all(0 <= r._score <= 1 for r in rows)
    quality = fit_quality(docs, labels, QualitySettings(epochs=3))
    rows = score_quality(odd, quality).collect()
    assert rows[0].score == rows[1].score and all(0 <= r.score <= 1 for r in rows)
    assert score_toxicity(docs.limit(0), model).count() == score_quality(docs.limit(0), quality).count() == 0


def test_no_labels(spark, documents):
    docs, none = documents([(1, "a"), (2, None)]), spark.createDataFrame([], LABELS)
    assert score_toxicity(docs, fit_toxicity(docs, none)).count() == 2
    assert score_quality(docs, fit_quality(docs, none)).count() == 2


def test_score_is_the_same_beside_any_neighbour():
    rng, size = np.random.default_rng(3), ToxicitySettings(buckets=64, dimensions=4, filters=8)
    p = {"words": rng.normal(size=(64, 4)).astype(np.float32), "out": rng.normal(size=24).astype(np.float32)}
    p |= {f"w{w}": rng.normal(size=(4 * w, 8)).astype(np.float32) for w in size.widths}
    p |= {f"b{w}": np.zeros(8, np.float32) for w in size.widths} | {"bias": np.zeros(1, np.float32)}
    p["words"][0] = 0
    model = ToxicityModel(size, p)
    texts = [rng.integers(1, 64, n).astype(np.int32) for n in (0, 1, 2, 3, 5, 0, 0, 1, 9000, 4, 4096, 2)]
    alone = [model.score([one], model.tables())[0] for one in texts]
    for order in (range(12), range(11, -1, -1), rng.permutation(12)):
        assert (model.score([texts[k] for k in order], model.tables()) == [alone[k] for k in order]).all()


def test_threshold():
    scores, labels = np.array([0.9, 0.8, 0.3, 0.2]), np.array([1, 1, 0, 0])
    assert 0.3 < best_threshold(scores, labels, np.ones(4)) < 0.8


def test_every_labelled_document_is_learned_from(spark, documents):
    """No label is left out for its number or length, and each text is learned from in one part at least."""
    docs = documents([(k, "long " * 20_000 if k % 50 == 0 else f"w{k}") for k in range(400)])
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(400)], LABELS)
    rows = all_labelled(docs, labels, "toxic")
    wanted = {r.doc_id for r in labels.where(fold("doc_id") != 0).collect()}
    assert {r.doc_id for r in rows.collect()} == wanted
    data = rows.select("doc_id", F.encode(F.col("doc_id").cast("string"), "UTF-8").alias("data"), "y")

    class Settings:
        epochs, per_part, seed, rate, decay = 3, 20, 5, 0.1, 0.0

    def learn(optimiser, texts, ys, rng):
        for one in texts:
            optimiser.p["seen"][int(one)] += 1

    for Settings.per_part in (20, 150, 1000):
        p = {"seen": np.zeros(400, np.float32)}
        train_by_parts(data, p, learn, Settings)
        assert {int(k) for k in np.flatnonzero(p["seen"])} == wanted


def test_too_few_labels_for_a_threshold(spark, documents):
    """A threshold is 0.5 then, and every row is judged."""
    docs = documents([(k, f"fine {k}" if k % 2 else f"bad {k}") for k in range(60)])
    labels = spark.createDataFrame([(k, 1 - k % 2, 1) for k in range(60)], LABELS)
    model = fit_toxicity(docs, labels, ToxicitySettings(buckets=64, epochs=2))
    assert model.thresholds == {}
    rows = score_toxicity(docs, model).collect()
    assert all(r._toxic == (r._score >= 0.5) for r in rows) and len(rows) == 60


def test_calibration_restores_the_shares():
    """Nine of ten are label 1 at log odds 0, one of ten at -2: scores become these shares."""
    steps, labels = np.array([0, 0, -2, -2]) * STEPS, np.array([1.0, 0.0, 1.0, 0.0])
    scale, shift = calibrate(steps.astype(float), labels, np.array([9e4, 1e4, 1e4, 9e4]))
    assert abs(1 / (1 + np.exp(-shift)) - 0.9) < 0.01 and abs(1 / (1 + np.exp(2 * scale - shift)) - 0.1) < 0.01
