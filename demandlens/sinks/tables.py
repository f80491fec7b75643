"""Stored tables, exports, the model and its metrics."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.lists import join_skills
from ..operators.placement import load_model, save_model
from ..sources.tables import table_exists


def write_table(df, path, lookup=()):
    """Overwrite a table. Columns in ``lookup`` get Bloom filters, so that the search for one id
    skips the row groups that do not hold it, whatever the order of the rows."""
    writer = df.write.mode("overwrite")
    for column in lookup:
        writer = (writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
                  .option("parquet.bloom.filter.adaptive.enabled", "true"))
    writer.parquet(path)


def replace_table(df, path):
    """Overwrite a table that ``df`` itself may be read from."""
    replace_tables(df.sparkSession, {path: df})


def replace_tables(spark, tables):
    """Replace several tables, path -> rows, together.

    All new tables are written beside the old ones first, so a failure while computing or
    writing leaves every old table as it was. Then each old table is set aside and the new
    one takes its name; if that fails midway, the old ones are put back.
    """
    mark = uuid.uuid4().hex
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = {path: jvm.org.apache.hadoop.fs.Path(path.rstrip("/")) for path in tables}
    for path, df in tables.items():
        write_table(df, f"{at[path]}.{mark}.new")

    def move(path, source, target):
        here = at[path].getFileSystem(conf)
        source, target = (jvm.org.apache.hadoop.fs.Path(f"{at[path]}{x}") for x in (source, target))
        if here.exists(source) and not here.rename(source, target):
            raise OSError(f"cannot rename {source}")

    moved = []
    try:
        for path in tables:
            move(path, "", f".{mark}.old")
            moved.append(path)
            move(path, f".{mark}.new", "")
    except Exception:
        for path in moved:
            if at[path].getFileSystem(conf).exists(jvm.org.apache.hadoop.fs.Path(f"{at[path]}.{mark}.old")):
                at[path].getFileSystem(conf).delete(at[path], True)
                move(path, f".{mark}.old", "")
        raise
    for path in tables:
        at[path].getFileSystem(conf).delete(jvm.org.apache.hadoop.fs.Path(f"{at[path]}.{mark}.old"), True)


def with_text_lists(df, missing=""):
    """List columns as ``;`` text; an empty list is empty text, a null one ``missing``."""
    def column(field):
        if isinstance(field.dataType, T.ArrayType):
            return F.coalesce(join_skills(F.col(field.name)), F.lit(missing)).alias(field.name)
        return field.name
    return df.select(*[column(f) for f in df.schema])


def export_csv(df, path):
    """CSV with a header, quotes doubled, white space kept; lists joined by ``;``. An empty list
    or text is a quoted empty cell, null is a cell without anything."""
    (with_text_lists(df, missing=None).write.mode("overwrite").option("header", True)
     .option("quote", '"').option("escape", '"').option("emptyValue", '""')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_metrics(metrics, path):
    metrics.write.mode("overwrite").json(path)


def publish(spark, base, prefix, target, tables):
    """Copy the tables that exist under ``base`` to ``target``/``prefix``;
    returns the keys written, in the given order."""
    prefix = prefix.strip("/")
    written = []
    for table, fmt in tables.items():
        key = f"{prefix}/{table}" if prefix else table
        if fmt == "model":
            model = load_model(spark, f"{base}/{table}")
            if model is None:
                continue
            save_model(model, f"{target}/{key}")
        elif table_exists(spark, f"{base}/{table}", fmt):
            spark.read.format(fmt).load(f"{base}/{table}").write.mode("overwrite").format(fmt).save(f"{target}/{key}")
        else:
            continue
        written.append(key)
    return written


PUBLISHED = {"job_postings_skills": "parquet", "market_skill_demand": "parquet",
             "student_skill_gaps": "parquet", "placement_scores": "parquet",
             "placement_model": "model",             "model_metrics": "json"}
