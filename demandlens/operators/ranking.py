"""Order-dependent steps that stay spread over the cluster.

A window without a partition, and an exact ``median``, pull a whole column
into one task. Here rows are range-partitioned on the sort key, each partition
is ranked on its own, and the partitions before it give the offset. The ranged
rows are checkpointed first: partition numbers must not change when a lost
task is run again.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.hashing import draw_long
from ..functions.numbers import nan_to_null
from ..functions.sizing import broadcast_if_small
from ..session import durable

_FIRST, _PREVIOUS = W.unboundedPreceding, -1


def running_total(df, order_by, weight, out, within=()):
    """``out`` = sum of ``weight`` over the rows strictly before this one.

    ``order_by`` (inside each ``within`` group) should be unique; rows with the
    same key are ordered arbitrarily among themselves.
    """
    within, order_by = list(within), list(order_by)
    part = ["_part", *within]
    ranged = durable(df.repartitionByRange(*within, *order_by)
                     .withColumn("_part", F.spark_partition_id()))
    # One row per partition and group it holds: bounded by the partition count.
    earlier = W.partitionBy(*within, F.lit(0)).orderBy("_part").rowsBetween(_FIRST, _PREVIOUS)
    offsets = (ranged.groupBy(*part).agg(F.sum(weight).alias("_sum"))
               .select(*part, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset")))
    inside = W.partitionBy(*part).orderBy(*order_by).rowsBetween(_FIRST, _PREVIOUS)
    return (ranged.withColumn("_inside", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
            .join(offsets, part)
            .withColumn(out, F.col("_offset") + F.col("_inside"))
            .drop("_part", "_offset", "_inside"))


def sequential_ids(df, id_col, prefix, order_by=None):
    """``prefix0000``, ``prefix0001``, ... in the given order, or in the order of the files
    (by path, then by place in the file) when none is given.

    Without an order no row moves: rows are counted per file split, and each row adds its
    place in the split to the rows before the split. Rows that come from no file keep the
    order of their partitions; those must not be dealt anew between two runs.
    """
    keep = [c for c in df.columns if c != id_col]
    if order_by:
        numbered = running_total(df.withColumn("_one", F.lit(1)), list(order_by), "_one", "_at")
    else:
        numbered = _in_file_order(df)
    return numbered.select(
        F.format_string("%s%04d", F.lit(prefix), F.col("_at")).alias(id_col), *keep)


def _in_file_order(df):
    """Splits are numbered file by file: places inside a file from the splits of that file, and
    files by ranges of their paths, so that no task sees all splits."""
    split = ["_file", "_block", "_task"]
    rows = (df.withColumns({"_file": F.input_file_name(), "_block": F.input_file_block_start(),
                            "_read": F.monotonically_increasing_id()})
            .withColumn("_task", F.shiftright("_read", 33)))
    # One row per file split.
    sizes = rows.groupBy(*split).agg(F.count("*").alias("_n"), F.min("_read").alias("_first"))
    sizes = durable(sizes)
    files = running_total(sizes.groupBy("_file").agg(F.sum("_n").alias("_rows")), ["_file"], "_rows", "_earlier")
    own = W.partitionBy("_file").orderBy("_block", "_task").rowsBetween(_FIRST, _PREVIOUS)
    starts = (sizes.withColumn("_inside", F.coalesce(F.sum("_n").over(own), F.lit(0)))
              .join(files.select("_file", "_earlier"), "_file")
              .select(*split, "_first", (F.col("_earlier") + F.col("_inside")).alias("_before")))
    return (rows.join(broadcast_if_small(starts), split)
            .withColumn("_at", F.col("_before") + F.col("_read") - F.col("_first"))
            .drop(*split, "_read", "_first", "_before"))


def strict_percentile(df, value, out):
    """Share of all rows with a strictly smaller value; null where the value is null.

    Rows are dealt by ranges of (value, place), so a value that many rows share is cut over
    many ranges. A row's count is its rank in its range plus the rows before the range; the
    value that a range begins with may have begun in an earlier one, and takes the count
    from there. What passes between ranges is one row each; no row is joined on its value.
    """
    known = F.col(value).isNotNull()
    ranged = durable(df.where(known).withColumn("_place", F.monotonically_increasing_id())
                     .repartitionByRange(value, "_place").withColumn("_part", F.spark_partition_id()))
    by_value = ranged.groupBy("_part", value).agg(F.count("*").alias("_n"))
    parts = by_value.groupBy("_part").agg(
        F.sum("_n").alias("_rows"), F.min(value).alias("_first"), F.max(value).alias("_last"),
        F.max_by("_n", value).alias("_at_last"))
    earlier = W.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(_FIRST, _PREVIOUS)  # a row per range
    parts = parts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    begun = parts.groupBy(F.col("_last").alias("_first")).agg(
        F.min(F.col("_before") + F.col("_rows") - F.col("_at_last")).alias("_begun"))
    starts = parts.join(begun, "_first", "left").select(
        "_part", "_first", "_before", F.coalesce("_begun", "_before").alias("_begun"))
    total = df.agg(F.count("*")).scalar()
    inside = F.rank().over(W.partitionBy("_part").orderBy(value)) - 1
    below = F.when(F.col(value) == F.col("_first"), F.col("_begun")).otherwise(F.col("_before") + F.col("_inside"))
    ranked = (ranged.withColumn("_inside", inside).join(broadcast_if_small(starts), "_part")
              .withColumn(out, below / total).drop("_part", "_place", "_first", "_before", "_begun", "_inside"))
    unknown = df.where(~known).withColumn(out, F.lit(None).cast("double"))
    return ranked.unionByName(unknown.select(ranked.columns))


def exact_medians(df, columns, accuracy=20_000):
    """Exact medians as one row, nulls and NaN skipped.

    An approximate quantile pass brackets each median; rows below the bracket
    are only counted, and the few values inside it are counted per value and
    ranked.
    """
    values = df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in columns])
    margin = 2.0 / accuracy
    found = values.agg(*[F.struct(
        F.count(c).alias("rows"),
        F.percentile_approx(c, [0.5 - margin, 0.5 + margin], accuracy).alias("at")).alias(c)
        for c in columns]).first()
    known = [c for c in columns if found[c]["rows"]]
    if not known:
        return df.sparkSession.createDataFrame([(None,) * len(columns)], ", ".join(
            f"{c} double" for c in columns))

    def per_column(pick):
        return F.create_map(*[x for c in known for x in (F.lit(c), F.lit(pick(found[c])))])[
            F.col("indicator")]

    below = values.agg(*[F.count_if(F.col(c) < found[c]["at"][0]).alias(c) for c in known])
    below = below.unpivot([], known, "indicator", "n_lower")
    counts = (values.unpivot([], known, "indicator", "value")
              .where(F.col("value").between(per_column(lambda f: f["at"][0]),
                                            per_column(lambda f: f["at"][1])))
              .groupBy("indicator", "value").agg(F.count("*").alias("n")))
    ranked = (running_total(counts, ["value"], "n", "n_inside", within=["indicator"])
              .join(F.broadcast(below), "indicator")  # one row per column
              .withColumn("n_below", F.col("n_inside") + F.col("n_lower"))
              .withColumn("rows", per_column(lambda f: f["rows"])))

    def at(position):
        inside = (F.col("n_below") <= position) & (position < F.col("n_below") + F.col("n"))
        return F.max(F.when(inside, F.col("value")))

    lower, upper = F.floor((F.col("rows") - 1) / 2), F.floor(F.col("rows") / 2)
    medians = ranked.groupBy("indicator").agg(((at(lower) + at(upper)) / 2).alias("median"))
    return medians.agg(*[
        F.max(F.when(F.col("indicator") == c, F.col("median"))).alias(c) for c in columns])


def hash_sample(df, n, key, seed=42):
    """``min(n, rows)`` rows without replacement; the same rows every time.

    The rows with the smallest hash of the unique ``key`` are taken. Only the
    hash at which row ``n`` falls is looked for, in two narrow passes, and the
    rows are then filtered where they lie: a top-n would bring ``n`` full rows
    of every partition into one task. A key that repeats at the cut is refused,
    since its rows could only be taken together.
    """
    drawn = df.withColumn("_draw", draw_long(seed, F.col(key)))
    narrow = drawn.select("_draw", key, F.shiftright("_draw", 32).alias("_bucket"))
    taken, cut = 0, None
    # At most 2**16 rows, however large the table is.
    for row in sorted(narrow.groupBy("_bucket").count().collect()):
        if taken + row["count"] > n:
            cut = row["_bucket"]
            break
        taken += row["count"]
    if cut is None:
        return df
    if n == taken:
        return drawn.where(F.shiftright("_draw", 32) < cut).drop("_draw")
    # One bucket holds about 1/65536 of the rows.
    last = (narrow.where(F.col("_bucket") == cut).orderBy("_draw", key).limit(n - taken)
            .agg(F.max(F.struct("_draw", key)).alias("last")).first()["last"])
    at_cut = narrow.where((F.col("_draw") == last["_draw"]) & (F.col(key) == last[key])).limit(2).count()
    if at_cut > 1:
        raise ValueError(f"{key} is not unique; a sample needs a unique key")
    before = F.col("_draw") < last["_draw"]
    same = (F.col("_draw") == last["_draw"]) & (F.col(key) <= last[key])
    return drawn.where(before | same).drop("_draw")
