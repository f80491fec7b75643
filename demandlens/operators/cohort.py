"""Cohort views: tiers, distribution, medians, common gaps, interventions."""

from pyspark.sql import functions as F

from ..fixed_values import TIER_BOUNDS, TOP_GAPS_COHORT, TOP_GAPS_LISTED
from ..functions.lists import each
from ..functions.numbers import risk_tier

INDICATORS = ("cgpa", "projects_count", "certifications_count", "internships_count",
              "market_alignment_score")


def feature_frame(students, gaps):
    """Students with the two features the gap table adds (inner, by id)."""
    return students.join(
        gaps.select("student_id", "skill_count", "market_alignment_score"), "student_id")


def score_cohort(features, scorer=None):
    """Probability and tier; without a model null and ``Unknown``."""
    scored = (features.withColumn("probability", F.lit(None).cast("double"))
              if scorer is None else scorer(features))
    return scored.withColumn("tier", risk_tier(F.col("probability")))


def tier_counts(cohort):
    """Students per tier, zero-filled, in fixed order."""
    tiers = [t for t, _ in TIER_BOUNDS]
    one = cohort.agg(*[F.count_if(F.col("tier") == t).alias(t) for t in tiers])
    return one.select(F.posexplode(F.array(*[
        F.struct(F.lit(t).alias("tier"), F.col(f"`{t}`").alias("students")) for t in tiers])
    ).alias("tier_pos", "entry")).select("tier_pos", "entry.*")


def cohort_kpis(cohort):
    """Students, mean probability and, where outcomes are known, their rate."""
    placed = F.avg("placed") if "placed" in cohort.columns else F.lit(None).cast("double")
    return cohort.agg(F.count("*").alias("students"),
                      F.avg("probability").alias("mean_probability"),
                      placed.alias("placement_rate"))


def placement_rate(students):
    return students.agg(F.avg("placed").alias("placement_rate"))


def probability_histogram(cohort, bins=25):
    """Students per probability bin and tier; bin 1 starts at 0."""
    at = F.least(F.width_bucket("probability", F.lit(0.0), F.lit(1.0), F.lit(bins)), F.lit(bins))
    return (cohort.where(F.col("probability").isNotNull())
            .groupBy(at.cast("int").alias("bin"), "tier").agg(F.count("*").alias("students")))


def alignment_scatter(cohort):
    return cohort.select("student_id", "market_alignment_score", "probability", "tier",
                         "skill_count")


def common_gaps(gaps, top=15, per_student=TOP_GAPS_COHORT):
    """Skills most often among a student's first gaps."""
    return (each(gaps, F.slice("missing_skills_ranked", 1, per_student), "skill")
            .groupBy("skill").agg(F.count("*").alias("students"))
            .orderBy(F.desc("students"), "skill").limit(top))


def deltas_to_median(cohort, medians, indicators=INDICATORS):
    """Each indicator minus the cohort median (a one-row frame)."""
    middle = medians.select(F.struct(*indicators)).scalar()
    return (cohort.withColumn("_median", middle)
            .withColumns({f"{c}_delta": F.col(c) - F.col("_median")[c] for c in indicators})
            .drop("_median"))


def tier_is(tiers):
    """Rows of the chosen tiers; choosing none gives none."""
    return F.col("tier").isin(list(tiers)) if tiers else F.lit(False)


def intervention_list(cohort, gaps, tiers=("At risk", "Needs a push")):
    """Students of the chosen tiers, lowest probability first, with their top
    gaps."""
    return (cohort.where(tier_is(tiers))
            .join(gaps.select("student_id", "missing_skills_ranked"), "student_id")
            .select("student_id", "tier", "probability", "cgpa", "internships_count",
                    "market_alignment_score",
                    F.array_join(F.slice("missing_skills_ranked", 1, TOP_GAPS_LISTED), ", ")
                    .alias("top_gaps"))
            .orderBy("probability", "student_id"))
