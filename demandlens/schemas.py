"""Explicit schemas; nothing is inferred from data."""

from pyspark.sql import types as T

_STR, _DBL, _INT, _LONG = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()
_LIST = T.ArrayType(T.StringType())


def _table(**columns):
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


POSTINGS = _table(posting_id=_STR, title=_STR, company=_STR, description=_STR,
                  true_skills=_LIST)
STUDENTS = _table(student_id=_STR, cgpa=_DBL, projects_count=_INT,
                  certifications_count=_INT, internships_count=_INT,
                  skills=_LIST, placed=_INT)
MARKET = _table(skill=_STR, posting_count=_LONG, pct_postings=_DBL, demand_rank=_INT)
GAPS = _table(student_id=_STR, matched_skills=_LIST, missing_skills_ranked=_LIST,
              market_alignment_score=_DBL, skill_count=_INT)
TAXONOMY = _table(category=_STR, skill=_STR, case_sensitive=T.BooleanType(),
                  category_pos=_INT, skill_pos=_INT)
MESSAGE = _table(posting_id=_STR, title=_STR, company=_STR, description=_STR,
                 true_skills=_STR)
