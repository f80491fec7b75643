"""Medians and percentiles of a cohort that grows batch by batch, from stored sketches.

A batch leaves one quantile sketch (KLL) per indicator, a few KB whatever its size. Sketches of
all batches are merged when asked, so no earlier row is read again. Ranks are off by
``rank_error`` of all rows at most (0.1 % for the default), and exact while no more than k
values have been seen; a percentile also by the width of its grid. ``ranking.exact_medians``
and ``strict_percentile`` stay the default.
"""

from pyspark.sql import functions as F

from ..functions.numbers import nan_to_null

K = 4096
#: Quantiles that a percentile is looked up among.
GRID = 1024


def rank_error(k=K):
    """The share of rows by which a rank may be off, with 99 % confidence."""
    return 2.446 / k ** 0.9433


def sketches(df, columns, k=K):
    """indicator, sketch, n: one row per column; nulls and NaN are skipped."""
    values = df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in columns])
    one = values.agg(*[F.struct(F.kll_sketch_agg_double(c, F.lit(k)).alias("sketch"), F.count(c).alias("n")).alias(c)
                       for c in columns])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("indicator"), F.col(f"{c}.sketch").alias("sketch"), F.col(f"{c}.n").alias("n"))
        for c in columns]))).where("n > 0")


def store_sketches(df, columns, path, batch, k=K):
    """The sketches of a batch in a folder of its own; a batch that runs again replaces it."""
    sketches(df, columns, k).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def merged_sketches(spark, path, k=K):
    """indicator, sketch, n over all stored batches."""
    stored = spark.read.schema("indicator string, sketch binary, n bigint, batch long").parquet(path)
    return stored.groupBy("indicator").agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"),
                                           F.sum("n").alias("n"))


def sketched_medians(merged, columns):
    """One row like ``exact_medians``; null for an indicator without values. Of two middle
    values the smaller one is taken."""
    median = F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)).alias("median")
    return merged.select("indicator", median).agg(*[
        F.max(F.when(F.col("indicator") == c, F.col("median"))).alias(c) for c in columns])


def sketched_percentile(df, value, out, merged, grid=GRID):
    """Share of all known rows with a strictly smaller value, by the sketch of column ``value``:
    how many of its ``grid`` even quantiles are smaller. Null without a value or a sketch."""
    ranks = F.array(*[F.lit(i / grid) for i in range(1, grid + 1)])
    own = merged.where(F.col("indicator") == value).select(
        F.kll_sketch_get_quantile_double("sketch", ranks).alias("_grid"))
    smaller = F.size(F.filter("_grid", lambda q: q < F.col(value))) / F.lit(float(grid))
    return (df.join(F.broadcast(own), how="left")  # one row
            .withColumn(out, F.when(F.col(value).isNotNull() & F.col("_grid").isNotNull(), smaller)).drop("_grid"))
