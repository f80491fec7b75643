"""Whitening against plain numpy."""

import math

import numpy as np
import pytest
from compare import connect
from demandlens.llm import catalog, whitening
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, copies string, x int"


def plain(rows, weights="counts"):
    """id -> (n, deviation), the centred x, their eigenvalues and eigenvectors."""
    x = {i: tuple(math.floor(1024 * float(np.float32(c))) + 100000 for c in v) for i, v in rows}
    fit = list(x.values()) if weights == "counts" else sorted(set(x.values()))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    exact = {i: (n, sum((n * a - s) ** 2 for a, s in zip(v, sums))) for i, v in x.items()}
    mean = np.array([s / n for s in sums])
    m = np.array(fit, float) - mean
    e, v = np.linalg.eigh(m.T @ m / n)
    return exact, {i: np.array(w, float) - mean for i, w in x.items()}, e[::-1], v[:, ::-1]


def test_query_equals_numpy(spark):
    rows = connect(SF).execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    exact, centred, e, v = plain(rows)
    got = catalog.QUERIES["op11_embedding_whitening"](spark, SF).collect()
    assert len(got) == 8 * len(rows) and {(r.vec_id, r.component) for r in got} == {
        (i, c) for i, _ in rows for c in range(1, 9)}
    sign = {}
    for r in got:
        c = r.component - 1
        want = centred[r.vec_id] @ v[:, c] / math.sqrt(e[c])
        if abs(want) > 1e-3:
            sign.setdefault(c, 1 if want * r.whitened > 0 else -1)
        assert (r.n, r.deviation) == exact[r.vec_id]
        assert r.whitened == pytest.approx(sign.get(c, 1) * want, abs=1e-8)
        assert r.explained == pytest.approx(e[c] / e.sum(), rel=1e-9)
        assert r.identity_error < 1e-8
    assert len({r.identity_error for r in got}) == 1


def made(seed=3, n=300, d=5):
    """Vectors a third of which are one and the same."""
    draw = np.random.default_rng(seed)
    same = draw.normal(0, 1, d)
    return [(i, [float(c) for c in np.float32(same if i % 3 == 0 else draw.normal(0, 1 + np.arange(d)))]) for i in range(n)]


@pytest.mark.parametrize("weights", ["counts", "one"])
def test_hot_vector_and_weights(spark, weights):
    rows = made()
    exact, centred, e, v = plain(rows, weights)
    frame = spark.createDataFrame([(i, c, "mine", 1) for i, c in rows], SCHEMA).repartition(7)
    got = whitening.whiten(frame, weights=weights).collect()
    assert sorted(r.id for r in got) == [i for i, _ in rows]
    for r in got:
        assert (r.n, r.deviation) == exact[r.id]
        want = centred[r.id] @ v / np.sqrt(e)
        assert np.allclose(np.abs(r.whitened), np.abs(want), atol=1e-8)
        assert r.explained == pytest.approx((e / e.sum()).tolist()) and r.identity_error < 1e-8


def test_unsound_rows_go_and_odd_ids_stay(spark):
    rows = [(i, v) for i, v in made(n=40, d=3)]
    odd = [(900, None), (901, []), (902, [1.0, None, 2.0]), (903, [1.0, float("nan"), 2.0]),
           (904, [float("inf"), 0.0, 1.0]), (905, [1.0, 2.0]), (906, [1e30, 0.0, 0.0])]
    frame = spark.createDataFrame([(i, v, None, None) for i, v in rows + odd + [rows[1], (None, rows[2][1])]], SCHEMA)
    got = whitening.whiten(frame).collect()
    assert sorted(-1 if r.id is None else r.id for r in got) == sorted([i for i, _ in rows] + [rows[1][0], -1])
    assert {r.n for r in got} == {42}
    twice = [r for r in got if r.id == rows[1][0]]
    assert len(twice) == 2 and twice[0] == twice[1]


def test_no_rows_one_row_and_flat_directions(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(empty).collect() == [] and "whitened" in whitening.whiten(empty).columns
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25], "", 1)], SCHEMA)).collect()
    assert (one[0].n, one[0].deviation, one[0].whitened, one[0].explained) == (1, 0, [None, None], [None, None])
    assert one[0].identity_error is None
    flat = whitening.whiten(spark.createDataFrame([(i, [float(i), 1.0], "", 1) for i in range(4)], SCHEMA)).collect()
    assert all(r.whitened[0] is not None and r.whitened[1] is None for r in flat)
    assert flat[0].identity_error < 1e-9


def test_beyond_64_bits(spark):
    big = [(1, [2.0 ** 42, 0.0]), (2, [-(2.0 ** 42), 1.0]), (3, [0.0, 2.0])]
    exact, *_ = plain(big)
    got = whitening.whiten(spark.createDataFrame([(i, v, "", 1) for i, v in big], SCHEMA)).collect()
    assert {r.id: r.deviation for r in got} == {i: d if d < 1 << 63 else None for i, (_, d) in exact.items()}


def test_joins_have_no_hot_key(spark):
    frame = spark.createDataFrame([(i, c, "", 1) for i, c in made()], SCHEMA)
    rows = whitening.whiten(frame)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "Cross" not in plan
    assert rows.where(F.col("whitened").isNull()).count() == 0
