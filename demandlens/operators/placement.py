"""Placement model: two candidates, the better held-out AUC is kept."""

import math
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ..fixed_values import FEATURES
from ..functions.hashing import draw_long
from ..functions.numbers import logistic
from ..session import durable, scratch_path
from .boosting import BoostedTreesModel, fit_boosted
from .cohort import feature_frame
from .ranking import running_total

training_table = feature_frame
MAX_CLASSES = 100


def complete_rows(df, features=FEATURES):
    return df.dropna(subset=[*features, "placed"]).withColumn("placed", F.col("placed").cast("int"))


def class_counts(df):
    """Rows per outcome; an outcome column with more than a few values is an error."""
    found = df.groupBy("placed").count().limit(MAX_CLASSES + 1).collect()
    if len(found) > MAX_CLASSES:
        raise ValueError(f"placed has more than {MAX_CLASSES} values")
    return {r["placed"]: r["count"] for r in found}


def trainable(df):
    """Whether ``check_classes`` lets a table pass."""
    try:
        check_classes(class_counts(df))
        return True
    except ValueError:
        return False


def check_classes(counts):
    if len(counts) < 2 or min(counts.values()) < 4:
        raise ValueError("training needs two outcomes with 4 students each; "
                         f"rows per value of placed: {counts}")


def split(df, share=0.25, seed=42, key="student_id"):
    """``is_test`` for the first rows of each class in hash order.

    Every class gives the same share, and the rows are the same in every run.
    The position in hash order is found without a window over a whole class.
    """
    drawn = df.withColumns({"_draw": draw_long(seed, F.col(key)), "_one": F.lit(1)})
    placed = running_total(drawn, ["_draw", key], "_one", "_at", within=["placed"])
    sizes = df.groupBy("placed").agg(F.round(F.count("*") * share).alias("_n_test"))
    return (placed.join(F.broadcast(sizes), "placed")  # two rows
            .withColumn("is_test", F.col("_at") < F.col("_n_test"))
            .drop("_draw", "_one", "_at", "_n_test"))


def feature_stages(n_train, features=FEATURES):
    """Features centred and scaled by the population deviation of the training
    rows (the scaler divides by the sample deviation)."""
    factor = math.sqrt(n_train / (n_train - 1.0)) if n_train > 1 else 1.0
    return [
        VectorAssembler(inputCols=list(features), outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="sample_scaled",
                       withMean=True, withStd=True),
        ElementwiseProduct(inputCol="sample_scaled", outputCol="features",
                           scalingVec=Vectors.dense([factor] * len(features))),
    ]


class StoredLogisticRegression(LogisticRegression):
    """Logistic regression whose model is stored and loaded once. A model as fitted holds its
    training summary and with it the session, which no task can take once the session has
    observed a query (``DataFrame.observe``); the loaded model is the same without it."""

    def _fit(self, dataset):
        path = scratch_path(dataset.sparkSession, "logistic")
        super()._fit(dataset).write().save(path)
        return LogisticRegressionModel.load(path)


def logistic_learner(n_train):
    """Logistic regression with an L2 penalty of weight 1 on the summed loss."""
    return StoredLogisticRegression(labelCol="placed", maxIter=1000, tol=1e-9, regParam=1.0 / n_train,
                                    elasticNetParam=0.0, standardization=False)


def with_probability(model, df):
    keep = [c for c in df.columns if c != "probability"]
    scored = model.transform(df)
    if not isinstance(model.stages[-1], BoostedTreesModel):
        scored = scored.withColumn("probability", F.get(vector_to_array("probability"), 1))
    return scored.select(*keep, "probability")


def model_scorer(model):
    """Scorer of a fitted pipeline. A logistic model becomes a plain column
    expression, so scoring stays inside generated code."""
    last = model.stages[-1]
    if hasattr(last, "coefficients"):
        intercept, weights = plain_weights(model)
        return linear_scorer(intercept, weights)
    return lambda df: with_probability(model, df)


def linear_scorer(intercept, weights):
    return lambda df: df.withColumn("probability", logistic(intercept, weights))


def plain_weights(model):
    """Intercept and weight per unscaled feature of a fitted logistic model."""
    assembler, scaler, factor, fitted = model.stages
    intercept, weights = float(fitted.intercept), {}
    rows = zip(assembler.getInputCols(), fitted.coefficients.toArray(), scaler.mean.toArray(),
               scaler.std.toArray(), factor.getScalingVec().toArray())
    for name, coefficient, mean, std, scale in rows:
        weight = float(coefficient * scale / std) if std else 0.0
        weights[name] = weight
        intercept -= weight * float(mean)
    return intercept, weights


def auc(scored, label="placed", score="probability"):
    """Exact ROC AUC as a one-row frame: rank sum with ties counted half."""
    grouped = (scored.where(F.col(score).isNotNull()).groupBy(score).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")))
    below = running_total(grouped, [score], "neg", "neg_below")
    won = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return below.agg((won / F.nullif(pairs, F.lit(0.0))).alias("auc"))


def confusion(scored, label="placed", score="probability"):
    return (scored.withColumn("predicted", (F.col(score) > 0.5).cast("int"))
            .groupBy(F.col(label).alias("label"), "predicted").agg(F.count("*").alias("n")))


def accuracy(counts):
    """From the confusion counts."""
    hits = F.sum(F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0))
    return counts.agg((hits / F.sum("n")).alias("accuracy"))


def class_report(counts):
    """Precision, recall, F1 and support per class, 0 where undefined."""
    # At most four rows come in: label and prediction are 0 or 1.
    long = counts.select(F.inline(F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"),
                 F.lit(0).cast("bigint").alias("chosen"),
                 F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("bigint").alias("support"),
                 F.col("n").alias("chosen"), F.lit(0).cast("bigint").alias("hit")))))
    sums = long.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "chosen", "hit")])
    ratio = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    return sums.select(
        "class", ratio(F.col("hit"), F.col("chosen")).alias("precision"),
        ratio(F.col("hit"), F.col("support")).alias("recall"),
        ratio(F.col("hit") * 2.0, F.col("chosen") + F.col("support")).alias("f1"), "support")


@dataclass
class Trained:
    best: str
    model: PipelineModel
    results: dict = field(default_factory=dict)      # name -> auc, accuracy, report
    importances: dict = field(default_factory=dict)


def scaler_table(spark, scaling, features=FEATURES):
    """Mean and population deviation of each feature in a fitted scaler."""
    _, scaler, factor = scaling.stages
    rows = zip(features, scaler.mean.toArray(), scaler.std.toArray(), factor.getScalingVec().toArray())
    return spark.createDataFrame([(f, float(m), float(d / k)) for f, m, d, k in rows],
                                 "feature string, mean double, deviation double")


def logistic_gradient(training, scaling, learner, features=FEATURES):
    """Gradient of the mean penalised loss at the fitted weights, one row per feature. The
    problem is strictly convex, so zeros prove the fit."""
    model = learner.fit(scaling.transform(training).select("features", "placed"))
    return gradient(training, PipelineModel(stages=[*scaling.stages, model]), learner.getRegParam(), features)


def gradient(training, pipeline, penalty, features=FEATURES):
    """The same for a fitted logistic pipeline."""
    scored, model = pipeline.transform(training), pipeline.stages[-1]
    error = F.get(vector_to_array("probability"), 1) - F.col("placed")
    x = vector_to_array("features")
    means = scored.agg(*[F.avg(error * F.get(x, i)).alias(f) for i, f in enumerate(features)]).first()
    rows = [(f, float(means[f] + penalty * w)) for f, w in zip(features, model.coefficients.toArray())]
    return training.sparkSession.createDataFrame(rows, "feature string, gradient double")


def judged(held_out, scorers):
    """The name of the scorer with the highest AUC on the held-out rows (a tie keeps the
    first, an undefined AUC counts as none), and name -> auc, accuracy, report."""
    results = {}
    for name, scorer in scorers.items():
        scored = durable(scorer(held_out))
        counts = confusion(scored)
        results[name] = {
            "auc": auc(scored).first()["auc"],
            "accuracy": accuracy(counts).first()["accuracy"],
            "report": [r.asDict() for r in class_report(counts).orderBy("class").collect()],
        }
    return max(results, key=lambda n: -1.0 if results[n]["auc"] is None else results[n]["auc"]), results


def train(df, features=FEATURES, rounds=200, rows_per_task=50_000):
    """Fit both candidates on 75 %, keep the one with the higher AUC on the
    held-out rows (a tie keeps the first). ``rows_per_task`` sets how many tasks the
    training rows are worth."""
    rows = complete_rows(df, features)
    check_classes(class_counts(rows))
    # The fits read the training rows again and again.
    parts = durable(split(rows.select("student_id", *features, "placed")))
    training = parts.where(~F.col("is_test")).drop("is_test")
    held_out = parts.where(F.col("is_test")).drop("is_test")
    n_train = training.count()
    tasks = max(1, math.ceil(n_train / rows_per_task))  # no more of them than the rows are worth
    scaling = Pipeline(stages=feature_stages(n_train, features)).fit(training)
    ready = scaling.transform(training).select("features", "placed").coalesce(tasks).persist()
    models = {"logistic_regression": PipelineModel(stages=[*scaling.stages, logistic_learner(n_train).fit(ready)])}
    ready.unpersist()
    # splits of trees depend on the order of values only, so these need no scaling
    models["boosted_trees"] = PipelineModel(stages=[fit_boosted(training, features, rounds=rounds, tasks=tasks)])
    best, results = judged(held_out, {n: model_scorer(m) for n, m in models.items()})
    return Trained(best, models[best], results, importances(models[best], features))


def importances(model, features=FEATURES):
    """Signed coefficients of a logistic model, shares of the mean gain of trees."""
    last = model.stages[-1]
    if isinstance(last, BoostedTreesModel):
        return dict(zip(features, last.importances()))
    values = last.coefficients if hasattr(last, "coefficients") else last.featureImportances
    return dict(zip(features, [float(v) for v in values.toArray()]))


def importance_table(spark, trained):
    rows = [(f, w, abs(w)) for f, w in trained.importances.items()]
    return (spark.createDataFrame(rows, "feature string, weight double, size double")
            .orderBy("size", "feature"))


def metrics_table(spark, trained):
    """One row in the stored shape."""
    best = trained.results[trained.best]
    row = (trained.best, best["auc"], best["accuracy"], trained.importances,
           {n: {"auc": r["auc"], "accuracy": r["accuracy"]} for n, r in trained.results.items()})
    return spark.createDataFrame([row], (
        "best_model string, auc double, accuracy double, feature_importances map<string,double>, "
        "all_models map<string,struct<auc:double,accuracy:double>>"))


def metrics_long(metrics):
    """One row per model and measure, with a display label of the model."""
    wide = metrics.select(F.explode("all_models").alias("model", "m")).select("model", "m.*")
    return (wide.unpivot(["model"], ["auc", "accuracy"], "metric", "value")
            .withColumn("label", F.initcap(F.replace("model", F.lit("_"), F.lit(" ")))))


def save_model(model, path):
    model.write().overwrite().save(path)


def load_model(spark, path, features=FEATURES):
    """The stored pipeline, or ``None`` when it is absent or cannot predict."""
    try:
        model = PipelineModel.load(path)
        probe = spark.createDataFrame([tuple(0.0 for _ in features)], list(features))
        with_probability(model, probe).collect()
        return model
    except Exception:  # whatever is wrong with the stored model, there is none
        return None
