"""Skill lists: the ``;`` text form of CSV cells and the array form."""

from pyspark.sql import functions as F


def _strip(text):
    """Without white space of any kind at both ends."""
    return F.btrim(text, F.lit(" \t\n\r\x0b\f"))


def split_skills(cell):
    """``;`` text to array: trimmed, without blanks and the text ``nan``."""
    parts = F.transform(F.split(F.coalesce(F.col(cell) if isinstance(cell, str) else cell,
                                           F.lit("")), ";"), _strip)
    return F.filter(parts, lambda p: (p != "") & (F.lower(p) != "nan"))


def split_cells(cell, trim=False):
    """``;`` text to array keeping every non-blank element, ``nan`` included."""
    parts = F.split(F.coalesce(F.col(cell) if isinstance(cell, str) else cell, F.lit("")), ";")
    if trim:
        parts = F.transform(parts, _strip)
    return F.filter(parts, lambda p: p != "")


def join_skills(skills, separator=";"):
    return F.array_join(skills, separator)


def or_empty(skills):
    """Null list to empty list."""
    skills = F.col(skills) if isinstance(skills, str) else skills
    return F.coalesce(skills, F.array().cast("array<string>"))


def ordered_union(first, second):
    """Elements of both lists, first occurrence kept, in order."""
    return F.array_distinct(F.concat(first, second))


def each(df, elements, out, *keep, position=None):
    """One row per list element, with the columns ``keep``.

    A plain ``explode`` lets the optimizer put a "list is not empty" filter
    below it, which computes the list a second time; for a list that comes out
    of text extraction that doubles the job. The outer form has no such filter,
    and the row it adds for an empty list is dropped here.
    """
    elements = F.col(elements) if isinstance(elements, str) else elements
    if position:
        rows = df.select(*keep, F.posexplode_outer(elements).alias(position, out))
    else:
        rows = df.select(*keep, F.explode_outer(elements).alias(out))
    return rows.where(F.col(out).isNotNull())
