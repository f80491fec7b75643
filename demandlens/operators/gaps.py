"""Skill gaps, market alignment and category coverage per student.

With a market of ordinary size each student is one row and stays one row: the
ranked market is part of the plan, and no shuffle is needed. A larger market is
joined in long form. Both ways give the same table.
"""

from pyspark.sql import functions as F

from ..fixed_values import OTHER_CATEGORY, TOP_GAPS_STORED
from ..functions.lists import each, or_empty
from ..functions.lookup import lookup
from ..functions.sizing import fetch_small
from .demand import DemandProfile, with_category

MAX_INLINE_CATEGORIES = 64


def own_skills(skills="skills"):
    """The student's different skills."""
    return F.array_distinct(or_empty(skills))


def skill_gaps(students, market, top=TOP_GAPS_STORED, profile=None):
    """One row per student: matched skills and top missing skills in demand
    order, alignment (4 decimals) and number of different skills."""
    profile = profile or DemandProfile.load(market)
    if profile is None:
        return _skill_gaps_long(students, market, top)
    mine = own_skills()
    return students.select(
        "student_id",
        profile.matched(mine).alias("matched_skills"),
        profile.missing(mine, top).alias("missing_skills_ranked"),
        F.round(profile.alignment(mine), 4).alias("market_alignment_score"),
        F.size(mine).alias("skill_count"))


def _by_list(students, skills="skills"):
    """``students`` with ``_list``, a digest of their different skills, and one row
    (_list, mine) per digest. The long forms work on lists, not on ids: ids may repeat or
    be null, and students with the same skills are answered once."""
    mine = F.array_sort(own_skills(skills))
    keyed = students.withColumn("_list", F.md5(F.to_json(F.struct(mine.alias("mine")))))
    return keyed, keyed.select("_list", own_skills(skills).alias("mine")).dropDuplicates(["_list"])


def _covered(lists, demand, *by):
    """Summed posting count of each list's market skills."""
    return (each(lists, "mine", "skill", "_list").join(demand, "skill")
            .groupBy("_list", *by).agg(F.sum("posting_count").alias("_covered")))


def with_covered(students, market, skills="skills"):
    """``students`` plus ``_covered``, the summed posting count of their market skills."""
    keyed, lists = _by_list(students, skills)
    covered = _covered(lists, market.select("skill", "posting_count"))
    return (keyed.join(covered, "_list", "left").drop("_list")
            .withColumn("_covered", F.coalesce("_covered", F.lit(0))))


def _share(covered, demand):
    """``covered`` of all ``demand``, 0 where there is none."""
    return F.coalesce(covered / F.nullif(demand, F.lit(0)), F.lit(0.0))


def _skill_gaps_long(students, market, top):
    keyed, lists = _by_list(students)
    ranked = market.select("skill", "posting_count", "demand_rank")
    found = (each(lists, "mine", "skill", "_list").join(ranked, "skill").groupBy("_list").agg(
        F.sort_array(F.collect_list(F.struct("demand_rank", "skill"))).alias("hits"),
        F.sum("posting_count").alias("covered")))
    totals = market.agg(F.struct(F.sum("posting_count").alias("demand"),
                                 F.max("demand_rank").alias("skills"))).scalar()
    base = (lists.join(found, "_list", "left").withColumn("totals", totals)
            .withColumn("ranks", F.coalesce(F.transform("hits", lambda h: h["demand_rank"]),
                                            F.array().cast("array<int>"))))
    # The first ``top`` ranks a list lacks lie within the first ``top + matched`` ranks.
    lacking = F.slice(F.array_except(F.sequence(F.lit(1), F.size("ranks") + top), F.col("ranks")), 1, top)
    lacking = F.filter(lacking, lambda r: r <= F.col("totals")["skills"])
    missing = (each(base, lacking, "demand_rank", "_list")
               .join(ranked.select("demand_rank", "skill"), "demand_rank")
               .groupBy("_list").agg(F.transform(
                   F.sort_array(F.collect_list(F.struct("demand_rank", "skill"))),
                   lambda h: h["skill"]).alias("missing")))
    answers = base.join(missing, "_list", "left").select(
        "_list", or_empty(F.transform("hits", lambda h: h["skill"])).alias("matched_skills"),
        or_empty("missing").alias("missing_skills_ranked"),
        F.round(_share(F.coalesce("covered", F.lit(0)), F.col("totals")["demand"]), 4).alias("market_alignment_score"),
        F.size("mine").alias("skill_count"))
    return keyed.select("student_id", "_list").join(answers, "_list").drop("_list")


def market_alignment(students, market, out="alignment", skills="skills", profile=None):
    """Unrounded alignment of any skill list."""
    profile = profile or DemandProfile.load(market)
    if profile is not None:
        return students.withColumn(out, profile.alignment(own_skills(skills)))
    demand = market.agg(F.sum("posting_count")).scalar()
    return (with_covered(students, market, skills)
            .withColumn(out, _share(F.col("_covered"), demand)).drop("_covered"))


def off_market_skills(skills, matched):
    """The student's skills that no posting asks for; repeats are kept."""
    return F.filter(or_empty(skills), lambda s: ~F.array_contains(matched, s))


def gap_detail(gaps, market, taxonomy):
    """One row per student and missing skill: rank in the list, category,
    demand share and posting count."""
    long = each(gaps, "missing_skills_ranked", "skill", "student_id", position="at")
    demand = with_category(market.select("skill", "pct_postings", "posting_count"), taxonomy)
    return (long.join(demand, "skill", "left").select(
        "student_id", (F.col("at") + 1).alias("gap_rank"), "skill",
        F.coalesce("category", F.lit(OTHER_CATEGORY)).alias("category"),
        F.coalesce("pct_postings", F.lit(0.0)).alias("demand"),
        F.coalesce("posting_count", F.lit(0)).alias("posting_count")))


def _category_list(taxonomy):
    return taxonomy.groupBy("category").agg(F.min("category_pos").alias("category_pos"))


def category_coverage(students, market, taxonomy):
    """Per student and taxonomy category: covered share of its demand. Every
    category of the taxonomy appears, with 0 where nothing is in demand."""
    listed = fetch_small(_category_list(taxonomy), MAX_INLINE_CATEGORIES)
    profile = DemandProfile.load(market)
    if listed is None or profile is None:
        return _category_coverage_long(students, market, taxonomy)
    known = {r["skill"]: r["category"] for r in fetch_small(
        with_category(market.select("skill"), taxonomy))}
    # One lookup for all categories: skill -> its category and posting count.
    entry = lookup({r["skill"]: {"category": known[r["skill"]], "n": r["posting_count"]} for r in profile.rows},
                   "struct<category:string,n:bigint>")
    totals = {}
    for r in profile.rows:
        totals[known[r["skill"]]] = totals.get(known[r["skill"]], 0) + r["posting_count"]

    def row(at, found):
        own = F.aggregate(F.filter(found, lambda e: e["category"] == at["category"]), F.lit(0).cast("bigint"),
                          lambda total, e: total + e["n"])
        total = totals.get(at["category"])
        return F.struct(F.lit(at["category"]).alias("category"), F.lit(at["category_pos"]).alias("category_pos"),
                        (own / F.lit(float(total)) if total else F.lit(0.0)).alias("coverage"))

    ordered = sorted(listed, key=lambda r: r["category_pos"])
    found = F.filter(F.transform(own_skills(), entry), lambda e: e.isNotNull())
    rows = F.get(F.transform(F.array(found), lambda f: F.array(*[row(e, f) for e in ordered])), 0)
    return students.select("student_id", F.inline(rows))


def _category_coverage_long(students, market, taxonomy):
    demand = with_category(market.select("skill", "posting_count"), taxonomy)
    keyed, lists = _by_list(students)
    covered = _covered(lists, demand, "category")
    totals = demand.groupBy("category").agg(F.sum("posting_count").alias("total"))
    spine = _category_list(taxonomy).join(totals, "category", "left")
    listed = spine.agg(F.collect_list(F.struct("category", "category_pos", "total"))).scalar()
    answers = (lists.select("_list", F.inline(listed)).join(covered, ["_list", "category"], "left")
               .select("_list", "category", "category_pos",
                       _share(F.coalesce("_covered", F.lit(0)), F.col("total")).alias("coverage")))
    return keyed.select("student_id", "_list").join(answers, "_list").drop("_list")


def cohort_coverage(students, market, taxonomy):
    """Mean coverage per category over all students.

    A category's demand is the same for everyone, so the mean is
    sum(students with skill * postings with skill) / (students * demand): one
    count per skill instead of one row per student and category.
    """
    holders = (each(students, own_skills(), "skill")
               .groupBy("skill").agg(F.count("*").alias("holders")))
    wide = "decimal(38,0)"
    per_category = (with_category(market.select("skill", "posting_count"), taxonomy)
                    .join(holders, "skill", "left").groupBy("category").agg(
                        F.sum(F.coalesce("holders", F.lit(0)).cast(wide)
                              * F.col("posting_count").cast("decimal(19,0)")).alias("covered"),
                        F.sum("posting_count").alias("total")))
    n = students.agg(F.count("*")).scalar()
    mean = F.col("covered").cast("double") / F.col("total") / F.nullif(n, F.lit(0))
    return (_category_list(taxonomy).join(per_category, "category", "left")
            .select("category", "category_pos", F.coalesce(mean, F.lit(0.0)).alias("coverage")))
