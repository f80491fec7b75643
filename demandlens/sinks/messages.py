"""Table rows as JSON messages."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import with_text_lists


def postings_to_messages(df, key="posting_id"):
    """``key`` and ``value``: one JSON object per row, nulls written out, NaN written as
    null, lists as ``;`` text."""
    df = with_text_lists(df)

    def clean(field):
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(field.name), F.col(field.name)).alias(field.name)
        return F.col(field.name)
    body = F.to_json(F.struct(*[clean(f) for f in df.schema]), {"ignoreNullFields": "false"})
    return df.select(F.col(key).cast("string").alias("key"), body.alias("value"))


def first_rows(df, limit=None, order="posting_id"):
    return df.orderBy(order).limit(limit) if limit else df


def send_to_topic(messages, servers, topic):
    """Needs the Kafka connector on the class path."""
    (messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("topic", topic).save())


def send_to_folder(messages, path, mode="overwrite"):
    messages.select("value").write.mode(mode).text(path)
