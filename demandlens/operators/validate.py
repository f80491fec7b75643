"""Checks on an uploaded table.

All counts come from one pass, plus one grouped pass for duplicate ids; the
first failing check, in a fixed order, is the one that is reported.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import STUDENT_NUMERIC
from ..functions.numbers import number_or_null
from .ranking import sequential_ids


@dataclass
class Checked:
    prepared: DataFrame | None
    error: str | None
    violations: DataFrame | None


def trimmed_names(df):
    return df.toDF(*[c.strip() for c in df.columns])


def numeric_columns(required):
    return [c for c in STUDENT_NUMERIC if c in required]


def duplicate_ids(df, id_col):
    """Ids that occur more than once, with their count."""
    return (df.groupBy(id_col).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1))


def violations(df, numeric=(), description=None, id_col=None):
    """One row per check: its order, the check, the column and the bad rows.

    For ``not_empty`` and ``has_text`` the table fails when no row is left, so
    ``bad_rows`` is 1 or 0 there.
    """
    none = F.lit(0).cast("bigint")
    rows = F.count("*")
    checks = [("not_empty", "", F.when(rows == 0, 1).otherwise(0).cast("bigint"))]
    for c in numeric:
        checks.append(("numeric", c, F.count_if(number_or_null(F.col(c)).isNull())))
    if description:
        checks.append(("has_text", description, F.when(
            (rows > 0) & (F.count(description) == 0), 1).otherwise(0).cast("bigint")))
    one = df.agg(*[expr.alias(f"c{i}") for i, (_, _, expr) in enumerate(checks)])
    entries = [F.struct(F.lit(i).alias("check_order"), F.lit(check).alias("check_name"),
                        F.lit(column).alias("column_name"), F.col(f"c{i}").alias("bad_rows"))
               for i, (check, column, _) in enumerate(checks)]
    report = one.select(F.inline(F.array(*entries)))
    if id_col and id_col in df.columns:
        valid = df.where(F.col(description).isNotNull()) if description else df
        repeated = duplicate_ids(valid, id_col).agg(
            F.lit(len(checks)).alias("check_order"), F.lit("unique_id").alias("check_name"),
            F.lit(id_col).alias("column_name"),
            F.coalesce(F.sum(F.col("n_rows") - 1), none).alias("bad_rows"))
        report = report.unionByName(repeated)
    return report


_MESSAGES = {
    "not_empty": "The table has no rows",
    "numeric": "Column '{column}': {bad} value(s) are empty or not numbers",
    "has_text": "No row has a {column}",
    "unique_id": "{bad} row(s) repeat an id of column '{column}': duplicate ids are not allowed",
}


def validate_and_prepare(df, required, id_col, id_prefix):
    """Checked table: numbers coerced, skills never null, rows without a
    description dropped, string ids present and unique; or the first error."""
    df = trimmed_names(df)
    absent = [c for c in required if c not in df.columns]
    if absent:
        return Checked(None, "Missing from the file, but needed: " + ", ".join(absent), None)
    numeric = numeric_columns(required)
    description = "description" if "description" in required else None
    report = violations(df, numeric, description, id_col)
    failed = report.where(F.col("bad_rows") > 0).orderBy("check_order").limit(1).collect()
    if failed:
        first = failed[0]
        text = _MESSAGES[first["check_name"]].format(
            column=first["column_name"], bad=first["bad_rows"])
        return Checked(None, text, report)
    prepared = df.withColumns({c: number_or_null(F.col(c)) for c in numeric}) if numeric else df
    if "skills" in required:
        prepared = prepared.withColumn("skills", F.coalesce(F.col("skills").cast("string"), F.lit("")))
    if description:
        prepared = prepared.where(F.col(description).isNotNull())
    if id_col in prepared.columns:
        prepared = prepared.withColumn(id_col, F.col(id_col).cast("string"))
    else:
        prepared = sequential_ids(prepared, id_col, id_prefix)
    return Checked(prepared, None, report)


def missing_tables(uploaded, stored):
    """Labels of the tables that are neither uploaded nor stored."""
    return [f"{label}: none uploaded and none stored"
            for label, df in uploaded.items() if df is None and not stored.get(label)]


def may_retrain(students):
    """Outcomes exist and none is null."""
    if "placed" not in students.columns:
        return False
    row = students.agg(F.count("*").alias("n"), F.count("placed").alias("known")).first()
    return row["n"] > 0 and row["n"] == row["known"]
