import pytest
from pyspark.sql import functions as F

from demandlens.fixed_values import FEATURES, POSTING_REQUIRED, STUDENT_REQUIRED
from demandlens.operators import placement as P
from demandlens.operators import validate as V


def upload(spark, rows, columns):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns))


def check(df):
    return V.validate_and_prepare(df, STUDENT_REQUIRED, "student_id", "S")


def test_validation_cases(spark):
    good = upload(spark, [("1",) * 4 + ("Python",), ("2",) * 4 + (None,)],
                  [" cgpa ", *STUDENT_REQUIRED[1:]])
    ok = check(good)
    rows = ok.prepared.orderBy("student_id").collect()
    assert ok.error is None and [r["student_id"] for r in rows] == ["S0000", "S0001"]
    assert rows[1]["skills"] == "" and rows[0]["cgpa"] == 1.0
    bad = V.trimmed_names(good).withColumn("cgpa", F.when(F.col("cgpa") == "1", "8.1").otherwise("abc"))
    assert "cgpa" in check(bad).error and check(bad).prepared is None
    assert "duplicate" in check(V.trimmed_names(good).withColumn("student_id", F.lit("x"))).error
    assert "Missing" in check(good.drop("skills")).error
    assert "no rows" in check(good.limit(0)).error


def test_first_failing_check_wins(spark):
    df = upload(spark, [("x", "y", "1", "1", "", "i"), ("1", "1", "1", "1", "", "i")],
                [*STUDENT_REQUIRED, "student_id"])
    result = check(df)
    assert "cgpa" in result.error
    report = {(r["check_name"], r["column_name"]): r["bad_rows"] for r in result.violations.collect()}
    assert report[("numeric", "projects_count")] == 1 and report[("unique_id", "student_id")] == 1


def test_postings_without_text(spark):
    df = upload(spark, [("t", "c", None), ("t", "c", "text")], POSTING_REQUIRED)
    kept = V.validate_and_prepare(df, POSTING_REQUIRED, "posting_id", "JP")
    assert [r["posting_id"] for r in kept.prepared.collect()] == ["JP0000"]
    empty = V.validate_and_prepare(df.limit(1), POSTING_REQUIRED, "posting_id", "JP")
    assert "description" in empty.error


@pytest.mark.parametrize("text, number", [
    (" 8.5 ", 8.5), ("1e3", 1000.0), ("-.5", -0.5), ("1f", None), ("abc", None), ("", None),
    ("nan", None), (None, None)])
def test_numbers(spark, text, number):
    from demandlens.functions.numbers import number_or_null
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(number_or_null(F.col("x"))).first()[0] == number


def test_may_retrain(spark):
    df = spark.createDataFrame([(1,), (0,)], "placed int")
    assert V.may_retrain(df) and not V.may_retrain(df.union(spark.createDataFrame([(None,)], "placed int")))
    assert not V.may_retrain(df.drop("placed")) and not V.may_retrain(df.limit(0))
    assert V.missing_tables({"postings": None, "students": df}, {"postings": False}) == [
        "postings: none uploaded and none stored"]


def learnable(spark, n=400):
    x = lambda k: F.rand(k)
    df = spark.range(n).select(
        F.format_string("S%04d", "id").alias("student_id"), (x(1) * 4 + 5).alias("cgpa"),
        (x(2) * 6).cast("int").alias("projects_count"), (x(3) * 4).cast("int").alias("certifications_count"),
        (x(4) * 3).cast("int").alias("internships_count"), (x(5) * 9).cast("int").alias("skill_count"),
        x(6).alias("market_alignment_score"))
    return df.withColumn("placed", (F.col("cgpa") + F.col("internships_count") + x(7) > 8.5).cast("int"))


def test_refuses_one_outcome(spark):
    with pytest.raises(ValueError, match="placed"):
        P.train(learnable(spark, 10).withColumn("placed", F.lit(1)))


def test_split_is_stratified_and_stable(spark):
    df = learnable(spark)
    parts = P.split(df)
    sizes = {(r["placed"], r["is_test"]): r["count"] for r in parts.groupBy("placed", "is_test").count().collect()}
    for c in (0, 1):
        total = sizes[(c, True)] + sizes[(c, False)]
        assert sizes[(c, True)] == round(total * 0.25 + 1e-9)
    ids = lambda d: {r[0] for r in d.where("is_test").select("student_id").collect()}
    assert ids(parts) == ids(P.split(df.repartition(13)))


def test_train_save_load_score(spark, tmp_path):
    df = learnable(spark)
    trained = P.train(df, rounds=3)
    assert set(trained.results) == {"logistic_regression", "boosted_trees"}
    best = max(r["auc"] for r in trained.results.values())
    assert trained.results[trained.best]["auc"] == best > 0.8
    assert list(trained.importances) == list(FEATURES)
    metrics = P.metrics_table(spark, trained)
    long = P.metrics_long(metrics).collect()
    assert len(long) == 4 and {"Logistic Regression", "Boosted Trees"} == {r["label"] for r in long}
    sizes = [r["size"] for r in P.importance_table(spark, trained).collect()]
    assert sizes == sorted(sizes)
    path = str(tmp_path / "model")
    P.save_model(trained.model, path)
    loaded = P.load_model(spark, path)
    pair = P.with_probability(loaded, df).join(
        P.model_scorer(trained.model)(df).select("student_id", F.col("probability").alias("q")), "student_id")
    worst = pair.agg(F.max(F.abs(F.col("probability") - F.col("q")))).first()[0]
    assert worst < 1e-9


def test_linear_form_equals_the_pipeline(spark):
    from pyspark.ml import Pipeline
    df = learnable(spark)
    n = df.count()
    model = Pipeline(stages=[*P.feature_stages(n), P.logistic_learner(n)]).fit(df)
    both = P.model_scorer(model)(df).select("student_id", F.col("probability").alias("q")).join(
        P.with_probability(model, df), "student_id")
    assert both.agg(F.max(F.abs(F.col("probability") - F.col("q")))).first()[0] < 1e-9


def test_fitted_model_scores_in_a_session_that_observed(spark):
    from pyspark.ml import Pipeline
    from pyspark.sql import Observation
    spark.range(3).observe(Observation(), F.count("*").alias("n")).collect()
    df = learnable(spark, 50)
    scaling = Pipeline(stages=P.feature_stages(50)).fit(df)
    found = P.logistic_gradient(df, scaling, P.logistic_learner(50)).collect()
    assert len(found) == len(P.FEATURES) and all(abs(r.gradient) < 1e-3 for r in found)
    model = Pipeline(stages=[*P.feature_stages(50), P.logistic_learner(50)]).fit(df)
    assert P.with_probability(model, df).where("probability IS NOT NULL").count() == 50


def test_population_scaling(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    df = learnable(spark, 50)
    out = Pipeline(stages=P.feature_stages(50)).fit(df).transform(df).select(
        vector_to_array("features")[0].alias("x"))
    row = out.agg(F.avg("x"), F.stddev_pop("x")).first()
    assert abs(row[0]) < 1e-9 and row[1] == pytest.approx(1.0)


def test_unusable_model_is_no_model(spark, tmp_path):
    assert P.load_model(spark, str(tmp_path / "absent")) is None
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    Pipeline(stages=[VectorAssembler(inputCols=["cgpa"], outputCol="f")]).fit(
        learnable(spark, 10)).write().save(str(tmp_path / "odd"))
    assert P.load_model(spark, str(tmp_path / "odd")) is None


def test_auc_and_report_by_hand(spark):
    rows = [(1, 0.9), (1, 0.6), (0, 0.6), (0, 0.2), (1, 0.1)]
    df = spark.createDataFrame(rows, "placed int, probability double")
    wins = sum((p > q) + (p == q) / 2 for a, p in rows if a for b, q in rows if not b)
    assert P.auc(df).first()["auc"] == pytest.approx(wins / 6)
    counts = P.confusion(df)
    assert P.accuracy(counts).first()["accuracy"] == pytest.approx(3 / 5)
    one = P.class_report(counts).where("class = 1").first()
    assert (one["precision"], one["recall"], one["support"]) == (pytest.approx(2 / 3), pytest.approx(2 / 3), 3)
