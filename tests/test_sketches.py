"""Stored quantile sketches against exact ranks."""

import random
import statistics

import pytest
from demandlens.operators import sketches as S


def batches(spark, values, path, n=4, k=S.K):
    for i in range(n):
        S.store_sketches(spark.createDataFrame([(v, 1.0) for v in values[i::n]], "p double, q double"), ["p", "q"],
                         path, i, k)
    return S.merged_sketches(spark, path, k)


def test_exact_while_small(spark, tmp_path):
    draw = random.Random(1)
    values = [0.5] * 400 + [draw.random() for _ in range(601)] + [None, float("nan")]
    merged = batches(spark, values, str(tmp_path / "s"))
    known = [v for v in values if v is not None and v == v]
    assert S.sketched_medians(merged, ["p", "q"]).first()["p"] == statistics.median_low(known)
    df = spark.createDataFrame([(v,) for v in known[::7]] + [(None,)], "p double")
    for r in S.sketched_percentile(df, "p", "pct", merged).collect():
        want = None if r.p is None else sum(v < r.p for v in known) / len(known)
        assert r.pct == (want if want is None else pytest.approx(want, abs=1 / S.GRID))


def test_rank_error_is_bounded(spark, tmp_path):
    draw = random.Random(2)
    values = [draw.gauss(0, 1) for _ in range(40_000)] + [0.25] * 20_000
    k = 400
    merged = batches(spark, values, str(tmp_path / "s"), k=k)
    sizes = [len(r.sketch) for r in merged.collect()]
    assert max(sizes) < 40 * k
    ordered = sorted(values)
    df = spark.createDataFrame([(v,) for v in ordered[::6000] + [0.25]], "p double")
    for r in S.sketched_percentile(df, "p", "pct", merged).collect():
        assert abs(r.pct - sum(v < r.p for v in values) / len(values)) <= S.rank_error(k) + 1 / S.GRID
    median = S.sketched_medians(merged, ["p"]).first()["p"]
    below, upto = sum(v < median for v in values) / len(values), sum(v <= median for v in values) / len(values)
    assert below - S.rank_error(k) <= 0.5 <= upto + S.rank_error(k)


def test_a_batch_that_runs_again_counts_once(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.createDataFrame([(float(i),) for i in range(11)], "p double")
    for _ in range(2):
        S.store_sketches(df, ["p"], path, 0)
    S.store_sketches(df.where("p > 100"), ["p"], path, 1)
    row = S.merged_sketches(spark, path).first()
    assert (row.indicator, row.n) == ("p", 11)
    assert S.sketched_medians(S.merged_sketches(spark, path), ["p", "z"]).first().asDict() == {"p": 5.0, "z": None}
