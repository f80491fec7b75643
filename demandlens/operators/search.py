"""Search postings by skill."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..fixed_values import TOP_GAPS_SEARCHED, UNKNOWN_COMPANY
from ..functions.lists import each, or_empty
from ..functions.sizing import broadcast_if_small


def search_documents(extracted):
    """One document per posting; postings without skills stay in."""
    return extracted.select(
        "posting_id", "title",
        F.coalesce("company", F.lit(UNKNOWN_COMPANY)).alias("company"),
        or_empty("extracted_skills").alias("extracted_skills"))


def posting_index(documents):
    """Inverted table: one row per skill and posting."""
    return each(documents, "extracted_skills", "skill", "posting_id", "title", "company").select(
        "skill", "posting_id", "title", "company")


def write_index(index, path):
    """Full rebuild, sorted by skill.

    Ranges are cut on (skill, posting), so a skill that a third of the postings
    name is spread over many files, and a lookup still skips the other files by
    their statistics.
    """
    (index.repartitionByRange("skill", "posting_id")
     .sortWithinPartitions("skill", "posting_id").write.mode("overwrite").parquet(path))


def postings_with_skill(documents, skill):
    """Exact, case-sensitive."""
    return documents.where(F.array_contains("extracted_skills", skill))


def index_report(documents):
    """How many documents can be stored, and how many have no id."""
    return documents.agg(F.count("posting_id").alias("indexed"),
                         F.count_if(F.col("posting_id").isNull()).alias("rejected"))


def search_postings(documents, skill, size=6):
    """First postings with a skill, straight from the documents."""
    return postings_with_skill(documents, skill).orderBy("posting_id").limit(size)


def search_by_skill(index, skill, size=5):
    return index.where(F.col("skill") == skill).orderBy("posting_id").limit(size)


def first_hits(index, size):
    """First ``size`` postings of every skill.

    Spark cuts each partition to ``size`` rows per skill before the shuffle, so
    a frequent skill does not fill one task.
    """
    order = W.partitionBy("skill").orderBy("posting_id")
    return (index.withColumn("hit_rank", F.row_number().over(order))
            .where(F.col("hit_rank") <= size))


def gap_postings(gaps, index, size=6, searched=TOP_GAPS_SEARCHED):
    """For each of a student's first gaps, the first postings that ask for it."""
    wanted = each(gaps, F.slice("missing_skills_ranked", 1, searched), "skill", "student_id",
                  position="at")
    hits = broadcast_if_small(first_hits(index, size))
    return (wanted.join(hits, "skill")
            .select("student_id", (F.col("at") + 1).alias("gap_rank"), "skill", "hit_rank",
                    "posting_id", "title", "company"))


def nested_hits(index, size):
    """One row per skill: its first ``size`` postings as a list."""
    return first_hits(index, size).groupBy("skill").agg(F.sort_array(F.collect_list(F.struct(
        "hit_rank", "posting_id", "title", "company"))).alias("hits"))


def write_hits(index, table, path, size=6, buckets=64):
    """Store the first hits of every skill at a path, as a table bucketed by skill, a row each.
    Joins on the skill then read it without a shuffle."""
    (nested_hits(index, size).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, "skill").sortBy("skill").saveAsTable(table))


def gap_hits(gaps, hits, searched=TOP_GAPS_SEARCHED):
    """One row per student with the first gaps as a list, each with its list of postings:
    student_id, gaps (gap_rank, skill, hits). Gaps that no posting asks for are left out,
    students keep an empty list.

    ``hits`` is ``nested_hits`` or a table of ``write_hits``. A gap meets its postings as one
    row, so what is shuffled does not grow with the number of hits.
    """
    wanted = each(gaps, F.slice("missing_skills_ranked", 1, searched), "skill", "student_id",
                  position="at")
    found = wanted.join(hits, "skill").groupBy("student_id").agg(F.sort_array(F.collect_list(
        F.struct((F.col("at") + 1).alias("gap_rank"), "skill", "hits"))).alias("gaps"))
    empty = F.array().cast(found.schema["gaps"].dataType)
    return (gaps.select("student_id").join(found, "student_id", "left")
            .withColumn("gaps", F.coalesce("gaps", empty)))
