"""The skill taxonomy as a table."""

from .fixed_values import CASE_SENSITIVE_SKILLS, SKILL_TAXONOMY
from .schemas import TAXONOMY


def taxonomy_table(spark, taxonomy=None, case_sensitive=None):
    """One row per skill, from a dict category -> ordered skills."""
    if taxonomy is None:
        taxonomy, default_exact = SKILL_TAXONOMY, CASE_SENSITIVE_SKILLS
    else:
        default_exact = ()
    exact = set(default_exact if case_sensitive is None else case_sensitive)
    rows = [(category, skill, skill in exact, i, j)
            for i, (category, skills) in enumerate(taxonomy.items())
            for j, skill in enumerate(skills)]
    return spark.createDataFrame(rows, TAXONOMY)


def flat_skills(taxonomy=None):
    return [s for skills in (taxonomy or SKILL_TAXONOMY).values() for s in skills]


def categories(taxonomy=None):
    return list((taxonomy or SKILL_TAXONOMY).keys())
