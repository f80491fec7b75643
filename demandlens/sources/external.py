"""External files brought into the engine's schema."""

from pyspark.sql import functions as F

from ..fixed_values import DEGREE_SKILLS, SPECIALISATION_SKILLS
from ..functions.lists import or_empty
from ..operators.ranking import hash_sample
from .tables import table_exists


def normalise_postings(raw, n=None, seed=42):
    """Four columns, no null description, unlabelled; all postings, or a sample of ``n``."""
    kept = raw.select("job_id", "company_name", "title", "description").where(
        F.col("description").isNotNull())
    if n is not None:
        kept = hash_sample(kept, n, "job_id", seed)
    return kept.select(
        F.concat(F.lit("JP"), F.col("job_id").cast("string")).alias("posting_id"), "title",
        F.col("company_name").alias("company"), "description",
        F.lit(None).cast("array<string>").alias("true_skills"))


def _lookup(spark, entries, key, value):
    return F.broadcast(spark.createDataFrame(list(entries.items()),
                                             f"{key} string, {value} array<string>"))


def normalise_students(raw, degree_skills=None, specialisation_skills=None):
    """Grade proxy from three marks, skills imputed from degree and
    specialisation, yes/no fields to 0/1, absent counts 0."""
    spark = raw.sparkSession
    degree = _lookup(spark, degree_skills or DEGREE_SKILLS, "degree_t", "by_degree")
    spec = _lookup(spark, specialisation_skills or SPECIALISATION_SKILLS, "specialisation", "by_spec")
    mean = (F.col("ssc_p") + F.col("hsc_p") + F.col("degree_p")) / 3 / 10
    zero = F.lit(0)
    return (raw.join(degree, "degree_t", "left").join(spec, "specialisation", "left").select(
        F.format_string("S%04d", F.col("sl_no").cast("int")).alias("student_id"),
        F.round(mean, 2).alias("cgpa"),
        zero.alias("projects_count"), zero.alias("certifications_count"),
        F.when(F.col("workex") == "Yes", 1).otherwise(0).alias("internships_count"),
        F.sort_array(F.array_union(or_empty("by_degree"), or_empty("by_spec"))).alias("skills"),
        F.when(F.col("status") == "Placed", 1).otherwise(0).alias("placed")))


def choose_source(spark, external_paths, external, generated, fmt="csv"):
    """The external tables if every file is there, else the generated ones."""
    complete = all(table_exists(spark, p, fmt) for p in external_paths)
    return external() if complete else generated()
