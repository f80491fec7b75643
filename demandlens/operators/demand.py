"""Market demand: how many postings ask for a skill."""

import json

from pyspark.sql import functions as F

from ..fixed_values import OTHER_CATEGORY
from ..functions.lists import each
from ..functions.lookup import lookup
from ..functions.sizing import SMALL_ROWS, broadcast_if_small, fetch_small
from .ranking import running_total


def count_skills(long, n_postings):
    """Demand table from the long form. ``n_postings`` is a one-row frame or a
    number: all postings count, also those without a skill."""
    total = n_postings if isinstance(n_postings, int) else n_postings.scalar()
    return rank_demand(long.groupBy("skill").agg(F.count("*").alias("posting_count"))
                       .withColumn("pct_postings", F.col("posting_count") / total))


def market_demand(postings, skills="extracted_skills"):
    """Demand table of a postings table with a skill array.

    Counts list elements; blanks do not count. No posting gives an empty table
    with the same columns.
    """
    long = each(postings, skills, "skill").where(F.col("skill") != "")
    return count_skills(long, postings.agg(F.count("*").alias("n")))


def rank_demand(demand):
    """Rank by count, ties by name. The input has one row per skill.

    The vocabulary is ranked by ranges of (count, name) and the ranks before each range,
    never in one task; it is stored on the way, so what follows reads it again for free.
    """
    before = running_total(demand.withColumns({"_least": -F.col("posting_count"), "_one": F.lit(1)}),
                           ["_least", "skill"], "_one", "_at")
    return before.withColumn("demand_rank", (F.col("_at") + 1).cast("int")).drop("_least", "_one", "_at")


def title_matches(role, title="title"):
    """Literal, case-insensitive substring; a null title never matches."""
    return F.lower(F.coalesce(F.col(title), F.lit(""))).contains(role.strip().lower())


def market_demand_for_role(postings, role, skills="extracted_skills"):
    """Demand counted again over the postings whose title contains ``role``."""
    chosen = postings.where(title_matches(role)) if role.strip() else postings
    return market_demand(chosen, skills)


def with_category(df, taxonomy):
    """Category of each skill, ``Other`` for one the taxonomy does not know."""
    names = broadcast_if_small(
        taxonomy.groupBy("skill").agg(F.max_by("category", "category_pos").alias("category")))
    return (df.join(names, "skill", "left")
            .withColumn("category", F.coalesce("category", F.lit(OTHER_CATEGORY))))


def demand_tree(market, taxonomy):
    """Posting counts by category and skill with category and grand totals."""
    return (with_category(market, taxonomy).rollup("category", "skill")
            .agg(F.sum("posting_count").alias("posting_count"),
                 F.grouping_id().alias("level")))


def top_skills(market, n=20):
    """First ``n`` skills by demand, as many as there are."""
    return market.orderBy("demand_rank").limit(n)


def scaled_demand(market):
    """``market`` with its share relative to the largest share."""
    return market.withColumn("scaled", F.col("pct_postings") / market.agg(F.max("pct_postings")).scalar())


def market_kpis(postings, market, skills="extracted_skills"):
    """One row: postings, distinct skills, first skill and its share, mean
    number of skills per posting."""
    first = market.agg(F.count("*").alias("distinct_skills"),
                       F.min_by("skill", "demand_rank").alias("top_skill"),
                       F.max("pct_postings").alias("top_share"),
                       F.sum("posting_count").alias("mentions"))
    n_postings = postings.agg(F.count("*")).scalar()
    return (first.withColumn("postings", F.lit(n_postings) if isinstance(n_postings, int) else n_postings)
            .withColumn("mean_skills", F.coalesce("mentions", F.lit(0)) / F.col("postings"))
            .select("postings", "distinct_skills", "top_skill", "top_share", "mean_skills"))


class DemandProfile:
    """The demand table within a checked size, ready to be used inside a row.

    ``load`` computes the market once. Beyond ``limit`` skills it returns
    ``None`` and the callers take their long-form path. The cost per student
    depends on the student's own list, not on the size of the market.
    """

    INLINE = 4096

    def __init__(self, rows):
        self.rows = sorted(rows, key=lambda r: r["demand_rank"])
        self._entry = lookup(
            {r["skill"]: {"rank": r["demand_rank"], "n": r["posting_count"],
                          "share": r["pct_postings"]} for r in self.rows},
            "struct<rank:int,n:bigint,share:double>")

    @classmethod
    def load(cls, market, limit=INLINE):
        rows = fetch_small(market.select("skill", "posting_count", "pct_postings", "demand_rank"),
                           min(limit, SMALL_ROWS))
        return None if rows is None else cls(rows)

    @property
    def total(self):
        return sum(r["posting_count"] for r in self.rows)

    def names(self):
        """Skills as an array, by rank."""
        names = [r["skill"] for r in self.rows]
        return F.from_json(F.lit(json.dumps(names, ensure_ascii=False)), "array<string>")

    def count_of(self, skill):
        """Posting count, 0 for a skill no posting asks for."""
        return F.coalesce(self._entry(skill)["n"], F.lit(0))

    def share_of(self, skill):
        return F.coalesce(self._entry(skill)["share"], F.lit(0.0))

    def matched(self, skills):
        """The market skills of a list of different skills, by rank."""
        ranked = F.transform(skills, lambda s: F.struct(
            self._entry(s)["rank"].alias("rank"), s.alias("skill")))
        return F.transform(F.sort_array(F.filter(ranked, lambda r: r["rank"].isNotNull())),
                           lambda r: r["skill"])

    def missing(self, skills, top):
        """The first ``top`` market skills not in the list.

        They lie within the first ``top`` + list length ranks.
        """
        head = F.slice(self.names(), 1, F.size(skills) + top)
        return F.slice(F.array_except(head, skills), 1, top)

    def covered(self, skills):
        """Summed posting count of the market skills in a list, each once."""
        return F.aggregate(F.array_distinct(skills), F.lit(0).cast("bigint"),
                           lambda acc, s: acc + self.count_of(s))

    def alignment(self, skills):
        """Share of all demand covered, 0 when there is no demand.

        The denominator of ``pct_postings`` cancels, so the ratio is taken of
        whole numbers and does not depend on the order of summation.
        """
        if not self.total:
            return F.lit(0.0)
        return self.covered(skills) / F.lit(float(self.total))
