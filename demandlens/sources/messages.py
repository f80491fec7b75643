"""Postings as JSON messages."""

from pyspark.sql import functions as F

from ..schemas import MESSAGE


def decode(raw, value="value"):
    """Typed posting columns of JSON text; absent fields are null."""
    return raw.select(F.from_json(F.col(value).cast("string"), MESSAGE).alias("m")).select("m.*")


def topic_stream(spark, servers, topic, messages_per_trigger=1_000_000, **options):
    """Kafka topic from its earliest message, in batches of bounded size. Needs the Kafka
    connector on the class path; progress is kept by the query's checkpoint."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", "earliest")
              .option("maxOffsetsPerTrigger", messages_per_trigger))
    return decode(reader.options(**options).load())


def folder_stream(spark, path, files_per_trigger=None):
    """Folder of text files, one JSON message per line, behind the same schema."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return decode(reader.load(path))
