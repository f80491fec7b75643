"""Tables of the engine: Parquet between the stages, CSV at the edge."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import CSV_MISSING
from ..functions.lists import split_cells, split_skills
from ..functions.numbers import nan_to_null, number_or_null
from ..schemas import POSTINGS, STUDENTS


def table_exists(spark, path, fmt="parquet"):
    """Whether there is anything at the path. A table that is there but cannot be read is
    an error, not an absent one."""
    try:
        spark.read.format(fmt).load(path)
        return True
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def ready(spark, paths):
    """All required tables are present."""
    return all(table_exists(spark, p) for p in paths)


def read_table(spark, path, schema=None, columns=None):
    """Stored table, pruned to ``columns``; an absent one is an empty table
    with the right columns when a schema is given."""
    if schema is not None and not table_exists(spark, path):
        df = spark.createDataFrame([], schema)
    else:
        df = spark.read.schema(schema).parquet(path) if schema is not None else spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_csv(spark, path, columns=None, multi_line=False, lists=()):
    """Text columns of a CSV file with a header; missing-value texts are null, in columns of
    ``lists`` all but a quoted empty cell, which is an empty list there.

    Quoted line breaks need ``multi_line``, which reads a file in one piece; without it
    one file feeds many tasks.
    """
    raw = (spark.read.option("header", True).option("multiLine", multi_line)
           .option("quote", '"').option("escape", '"')
           .option("nullValue", "#N/A").csv(path))  # one of the missing texts: the default makes a quoted empty cell null
    raw = raw.select(*columns) if columns else raw
    return raw.select(*[F.when((F.col(f"`{c}`") == "") | ~F.col(f"`{c}`").isin(*CSV_MISSING) if c in lists
                               else ~F.col(f"`{c}`").isin(*CSV_MISSING), F.col(f"`{c}`")).alias(c)
                        for c in raw.columns])


def typed_columns(df, schema, lists):
    """Cast text columns to the schema; columns the file lacks become null. ``lists`` makes a list
    of a cell, and decides what a missing one is."""
    def column(field):
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        value = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return lists(value).alias(field.name)
        if isinstance(field.dataType, T.NumericType):
            return nan_to_null(number_or_null(value)).cast(field.dataType).alias(field.name)
        return value.cast(field.dataType).alias(field.name)
    return df.select(*[column(f) for f in schema])


def postings_from_csv(spark, path, multi_line=False):
    """A posting without a list of true skills is unlabelled: its list is null."""
    return typed_columns(read_csv(spark, path, multi_line=multi_line), POSTINGS,
                         lambda v: F.when(v.isNotNull(), split_skills(v)))


def students_from_csv(spark, path, multi_line=False):
    """Ids stay text. Skill lists keep every non-blank element; a quoted empty cell is an empty
    list, a missing one null (which counts as no skills wherever lists are used)."""
    return typed_columns(read_csv(spark, path, multi_line=multi_line, lists=("skills",)), STUDENTS,
                         lambda v: F.when(v.isNotNull(), split_cells(v, trim=True)))
