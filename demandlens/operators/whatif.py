"""What-if scoring for whole cohorts, and the full student view."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..fixed_values import STUDENT_NUMERIC, TOP_GAPS_SIMULATED
from ..functions.lists import each, or_empty, ordered_union
from ..functions.numbers import risk_tier
from .cohort import INDICATORS, deltas_to_median
from .demand import DemandProfile
from .gaps import gap_detail, market_alignment, off_market_skills, own_skills, with_covered
from .ranking import exact_medians, strict_percentile


def default_scenarios(gaps, top=TOP_GAPS_SIMULATED):
    """Every student learns the first gaps of the list."""
    return gaps.select("student_id", F.slice("missing_skills_ranked", 1, top).alias("add_skills"))


def simulate(cohort, scenarios, market, scorer):
    """Scenario outcome per student: new features, probability, tier and gains.

    ``scenarios`` has ``student_id``, ``add_skills`` and any of the numeric
    student columns; a null or absent value keeps the student's own. The new
    alignment is not rounded while the stored one is, as in the single-student
    view.
    """
    given = [c for c in STUDENT_NUMERIC if c in scenarios.columns]
    planned = scenarios.select("student_id", "add_skills",
                               *[F.col(c).alias(f"_new_{c}") for c in given])
    both = (cohort.withColumnRenamed("probability", "old_probability")
            .withColumnRenamed("market_alignment_score", "old_alignment")
            .drop("tier", "skill_count").join(planned, "student_id")
            .withColumns({c: F.coalesce(F.col(f"_new_{c}"), F.col(c)) for c in given})
            .withColumn("new_skills", ordered_union(or_empty("skills"), or_empty("add_skills")))
            .withColumn("skill_count", F.size("new_skills")))
    aligned = market_alignment(both, market, "market_alignment_score", "new_skills")
    return (scorer(aligned)
            .select("student_id", "new_skills", "skill_count",
                    F.col("market_alignment_score").alias("new_alignment"),
                    F.col("probability").alias("new_probability"),
                    risk_tier(F.col("probability")).alias("new_tier"),
                    (F.col("probability") - F.col("old_probability")).alias("probability_gain"),
                    (F.col("market_alignment_score") - F.col("old_alignment"))
                    .alias("alignment_gain")))


def levers(cohort, gaps, market, scorer, inline=True):
    """One row per student and missing skill: gain in probability if only that
    skill is learned, ranked per student.

    The skill count here is the list length plus one, without removing repeats.
    A missing skill adds its own posting count to the covered demand, so no
    skill list is built per scenario. ``inline=False`` joins the market even where it is
    small enough for the plan; the rows are the same.
    """
    long = (cohort.withColumnRenamed("probability", "old_probability")
            .join(gaps.select("student_id", "missing_skills_ranked"), "student_id"))
    profile = DemandProfile.load(market) if inline else None
    if profile is not None:
        own = long.withColumn("_covered", profile.covered(own_skills()))
        rows = (each(own, "missing_skills_ranked", "skill", "*")
                .withColumn("market_alignment_score",
                            (F.col("_covered") + profile.count_of(F.col("skill")))
                            / F.lit(float(profile.total or 1))))
    else:
        demand = F.coalesce(F.nullif(market.agg(F.sum("posting_count")).scalar(), F.lit(0)), F.lit(1))
        rows = (each(with_covered(long, market), "missing_skills_ranked", "skill", "*")
                .join(market.select("skill", "posting_count"), "skill", "left")
                .withColumn("market_alignment_score",
                            (F.col("_covered") + F.coalesce("posting_count", F.lit(0))) / demand))
    scored = scorer(rows.withColumn("skill_count", F.size(or_empty("skills")) + 1))
    # A student has at most ten gaps, so a group is never large.
    order = W.partitionBy("student_id").orderBy(F.desc("gain"), "skill")
    return (scored.withColumn("gain", F.col("probability") - F.col("old_probability"))
            .select("student_id", "skill", "gain", F.row_number().over(order).alias("lever_rank")))


def without_lever(lever_rows):
    """Per student: best gain, and whether no single skill helps."""
    return lever_rows.groupBy("student_id").agg(
        F.max("gain").alias("max_gain"), (F.max("gain") <= 0).alias("no_lever_helps"))


def student_view(cohort, gaps, market, taxonomy):
    """One wide row per student: indicators, distance to the cohort medians,
    percentile, matched, missing and off-market skills, and the gap table."""
    compared = deltas_to_median(cohort, exact_medians(cohort, list(INDICATORS)))
    ranked = strict_percentile(compared, "probability", "percentile")
    table = gap_detail(gaps, market, taxonomy).groupBy("student_id").agg(
        F.sort_array(F.collect_list(F.struct("gap_rank", "skill", "category", "demand")))
        .alias("gap_table"))
    return (ranked.join(gaps.select("student_id", "matched_skills", "missing_skills_ranked"),
                        "student_id")
            .join(table, "student_id", "left")
            .withColumn("off_market_skills", off_market_skills("skills", F.col("matched_skills"))))


def student(view, student_id):
    """Point lookup; the filter reaches the Parquet scan of a stored view."""
    return view.where(F.col("student_id") == student_id)
