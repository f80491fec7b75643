"""Market demand that runs along with a stream of postings."""

from pyspark.sql import functions as F

from ..operators.demand import rank_demand, title_matches


def start_demand(extracted, path, checkpoint, role=None, skills="extracted_skills", available_now=True,
                 every="10 seconds"):
    """Count the postings per skill of a stream that has a skill array.

    The running counts are a streaming aggregate: one entry per skill in the state store, and one
    for all postings, so a restart goes on from the last batch. ``role`` counts only postings whose
    title contains it. Each batch stores the counts that it changed below ``path``, in a
    folder of its own number, which a batch that runs again replaces. ``extracted`` is
    ``extract_skills`` over a stream or, for a vocabulary beyond the plan, the stored
    results of an extraction stream, read as a stream.
    """
    rows = extracted.where(title_matches(role)) if role and role.strip() else extracted
    # the entry without a skill stands for the posting itself
    entries = F.concat(F.array(F.lit(None).cast("string")), F.filter(skills, lambda s: s != ""))
    counts = (rows.select(F.explode(F.coalesce(entries, F.array(F.lit(None).cast("string")))).alias("skill"))
              .groupBy("skill").agg(F.count("*").alias("posting_count")))

    def store(batch, number):
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return (counts.writeStream.outputMode("update").foreachBatch(store)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def running_demand(spark, path):
    """The demand table as of the last stored batch, in the form of ``market_demand``."""
    stored = spark.read.schema("skill string, posting_count bigint, batch long").parquet(path)
    latest = stored.groupBy("skill").agg(F.max_by("posting_count", "batch").alias("posting_count"))
    total = latest.where("skill IS NULL").agg(F.max("posting_count")).scalar()
    return rank_demand(latest.where("skill IS NOT NULL")
                       .withColumn("pct_postings", F.col("posting_count") / total))
