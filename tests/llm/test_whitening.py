import math

import numpy as np
import pytest

from plantmetrics.llm.queries import QUERIES
from plantmetrics.llm.whitening import WhiteningSettings, covariance, square_sums, whiten_embeddings

SF = "/root/testdata/sf0.01"
ROWS = "vec_id long, embedding array<float>, x string, n int"


def _table(spark, vectors):
    return spark.createDataFrame([(k, v, "x", 1) for k, v in vectors], ROWS)


def _brute(vectors, components=4):
    """{row: values} from numpy and whole numbers alone."""
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in v] for v in vectors], dtype=object)
    fit = np.array(sorted({tuple(row) for row in x}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (fit * n - sums).astype(float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    white = ((x * n - sums).astype(float) / n) @ axes[:, order] / np.sqrt(values[order])
    deviation = ((x * n - sums) ** 2).sum(axis=1)
    return n, deviation, white, values[order] / values.sum()


def test_pair_squares_give_the_covariance():
    x = np.random.default_rng(0).integers(-900, 900, (57, 5))
    sums, centres = x.sum(axis=0).tolist(), np.array([3, -1, 0, 7, 500], dtype=object)
    got = covariance(square_sums(x - centres.astype(np.int64)), len(x), sums, centres)
    assert np.allclose(np.array(got, dtype=float), np.cov(x.T, bias=True), rtol=1e-13)
    large = np.array([[1 << 40, -(1 << 40)], [5, 1 << 39]])
    assert square_sums(large)[2] == (5 + (1 << 39)) ** 2


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    n, deviation, white, explained = _brute([r.embedding for r in rows])
    at = {r.vec_id: k for k, r in enumerate(rows)}
    got = QUERIES["op12_whitening"](spark, SF).collect()
    assert len(got) == 4 * len(rows)
    signs = {}
    for r in got:
        k, c = at[r.vec_id], r.component - 1
        sign = signs.setdefault(c, math.copysign(1, r.whitened * white[k, c]))
        assert r.n == n and r.deviation == deviation[k]
        assert abs(r.whitened - sign * white[k, c]) < 1e-7
        assert abs(r.explained / explained[c] - 1) < 1e-9 and r.identity_error < 1e-9


def test_copies_weigh_once_and_odd_rows_go(spark):
    rng = np.random.default_rng(1)
    vectors = [[float(c) for c in rng.normal(0, 1, 6)] for _ in range(40)]
    good = list(enumerate(vectors)) + [(k, vectors[0]) for k in range(100, 140)] + [(0, vectors[0]), (None, vectors[1])]
    odd = [(900, None), (901, []), (902, [1.0] * 5 + [None]), (903, [float("nan")] * 6), (904, [float("inf")] + [0.0] * 5), (905, [1.0])]
    got = whiten_embeddings(_table(spark, good + odd)).collect()
    n, deviation, white, _ = _brute([v for _, v in good])
    assert n == 40 and len(got) == 4 * len(good)
    assert {r.vec_id for r in got} == {k for k, _ in good} and {r.n for r in got} == {40}
    by = {(r.vec_id, r.component): r for r in got}
    assert by[0, 1].whitened == by[100, 1].whitened and by[None, 2].deviation == by[1, 2].deviation == deviation[1]
    for c in range(4):
        ours = np.array([by[k, c + 1].whitened for k in range(40)])
        assert min(np.abs(ours - white[:40, c]).max(), np.abs(ours + white[:40, c]).max()) < 1e-9
    again = whiten_embeddings(_table(spark, list(reversed(good + odd))).repartition(7)).collect()
    assert {(r.vec_id, r.component, round(r.whitened, 9)) for r in again} == {(r.vec_id, r.component, round(r.whitened, 9)) for r in got}


def test_no_variance_few_dimensions_and_large_entries(spark):
    same = whiten_embeddings(_table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert len(same) == 4 and all(r.whitened is None and r.explained == 0 and r.deviation == 0 and r.n == 1 for r in same)
    assert all(r.identity_error == 0 for r in same)
    line = whiten_embeddings(_table(spark, [(k, [k * 1.0, k * 2.0]) for k in range(5)])).collect()
    assert {r.component: r.whitened is None for r in line} == {1: False, 2: True}
    large = [(1, [1e30, 0.0, 1.0]), (2, [-1e30, 5.0, 2.0]), (3, [3.0, 1.0, 3.0]), (4, [0.5, 0.25, 9.0])]
    rows = whiten_embeddings(_table(spark, large), WhiteningSettings(components=3)).collect()
    assert len(rows) == 12 and {r.deviation for r in rows if r.vec_id == 1} == {None}
    assert whiten_embeddings(_table(spark, [])).count() == 0 == whiten_embeddings(_table(spark, [(1, None)])).count()


@pytest.mark.parametrize("name", ["vec_id", "n"])
def test_columns(spark, name):
    wanted = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whiten_embeddings(_table(spark, [(1, [1.0]), (2, [2.0])]), vec_id=name).columns == wanted
