"""Boosted trees against a plain version that sorts rows."""

import math

import numpy as np
import pytest
from demandlens.operators import boosting as B
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

NAMES = ["a", "b", "c"]


def rows(n=500, seed=4):
    draw = np.random.default_rng(seed)
    x = np.column_stack([draw.normal(size=n), draw.integers(0, 4, n), np.round(draw.random(n), 1)])
    p = 1 / (1 + np.exp(-(x[:, 0] + (x[:, 1] == 2) - 2 * x[:, 2] * (x[:, 0] > 0))))
    return x, (draw.random(n) < p).astype(int)


def frame(spark, x, y):
    return spark.createDataFrame([(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))],
                                 "id long, a double, b double, c double, placed int")


def plain(x, y, cuts, rounds, depth=3, rate=0.1, penalty=1.0, least=1.0):
    """Margins after Newton boosting with splits at the cuts."""
    margin = np.full(len(y), math.log(y.mean() / (1 - y.mean())))

    def grow(at, g, h, level):
        value = -rate * g[at].sum() / (h[at].sum() + penalty)
        best = (1e-6, None)
        if level < depth:
            for f in range(x.shape[1]):
                for cut in cuts[f]:
                    left, right = at[x[at, f] <= cut], at[x[at, f] > cut]
                    if h[left].sum() < least or h[right].sum() < least:
                        continue
                    score = sum(g[s].sum() ** 2 / (h[s].sum() + penalty) for s in (left, right))
                    score -= g[at].sum() ** 2 / (h[at].sum() + penalty)
                    if score > best[0] + 1e-9:
                        best = (score, (left, right))
        if best[1] is None:
            if level:
                margin[at] += value
            return
        for side in best[1]:
            grow(side, g, h, level + 1)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        grow(np.arange(len(y)), p - y, p * (1 - p), 0)
    return margin


def test_equals_plain_newton_boosting(spark):
    x, y = rows()
    df = frame(spark, x, y)
    cuts = B.cut_points(df, NAMES)
    assert [len(c) for c in cuts[1:]] == [3, 10] and len(cuts[0]) >= 200
    model = B.fit_boosted(df.repartition(5), NAMES, rounds=23)
    got = model.transform(df).orderBy("id").select("probability").toPandas()["probability"].to_numpy()
    want = 1 / (1 + np.exp(-plain(x, y, cuts, 23)))
    assert np.allclose(got, want, atol=1e-6)


def test_same_model_for_any_partitioning(spark):
    x, y = rows(300)
    df = frame(spark, x, y)
    models = [B.fit_boosted(d, NAMES, rounds=12, tasks=k).getOrDefault("trees")
              for d, k in ((df.repartition(7), None), (df.repartition(7), 3), (df.coalesce(1), None))]
    assert models[0] == models[1] == models[2]


def test_loss_falls_with_rounds(spark):
    x, y = rows()
    df = frame(spark, x, y)
    losses = []
    for n in (1, 10, 25):
        p = F.col("probability")
        scored = B.fit_boosted(df, NAMES, rounds=n).transform(df)
        losses.append(scored.agg(F.avg(-F.log(F.when(F.col("placed") == 1, p).otherwise(1 - p)))).first()[0])
    assert losses[0] > losses[1] > losses[2]


def test_save_load_nulls_and_flat_features(spark, tmp_path):
    x, y = rows(200)
    df = frame(spark, x, y).withColumn("c", F.lit(1.0))
    model = B.fit_boosted(df, NAMES, rounds=4)
    share = model.importances()
    assert share[2] == 0 and sum(share) == pytest.approx(1)
    PipelineModel(stages=[model]).write().overwrite().save(f"{tmp_path}/m")
    back = PipelineModel.load(f"{tmp_path}/m")
    probe = df.limit(20).union(df.limit(1).withColumn("a", F.lit(None).cast("double")))
    a, b = ([r.probability for r in m.transform(probe).collect()] for m in (model, back))
    assert a == b and a[-1] is None and None not in a[:-1]


def test_nothing_to_split(spark):
    df = spark.createDataFrame([(1.0, 0.0, 2.0, i % 2) for i in range(10)], "a double, b double, c double, placed int")
    model = B.fit_boosted(df, NAMES, rounds=5)
    assert model.grown() == []
    assert {r.probability for r in model.transform(df).collect()} == {0.5}
    with pytest.raises(ValueError):
        B.fit_boosted(df.where("placed = 1"), NAMES)
