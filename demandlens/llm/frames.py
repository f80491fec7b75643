"""Small helpers shared by the operators of this package."""

import pyarrow as pa
import pyarrow.compute as pc
from demandlens.session import scratch_path
from pyspark.sql import functions as F

#: The six ASCII blanks that separate words.
BLANKS = " \t\n\x0b\x0c\r"
#: Bytes of text that one step inside a task works on.
STEP_BYTES = 8 << 20


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def stored(df, name, arrow_rows=None):
    """``df`` written once to the shared folder and read back: lineage ends here,
    and a lost executor costs no recomputation. ``arrow_rows`` limits the batches that
    Python tasks of this write get, for tables of wide rows."""
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(ARROW_ROWS)
    try:
        spark.conf.set(ARROW_ROWS, arrow_rows or before)
        df.write.parquet(path)
    finally:
        spark.conf.set(ARROW_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df, name, key):
    """``df`` written once like ``stored``, in as many buckets of ``key`` as a shuffle has
    partitions: what groups or joins it by ``key`` reads it without a shuffle."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    label = path.rsplit("/", 1)[1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").option("path", path).bucketBy(buckets, key).saveAsTable(label)
    found = spark.table(label)
    spark.sql(f"DROP TABLE {label}")  # the name only: the files are at a path of their own
    return found


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(columns, name):
    """``name``, with underscores in front until no column has it (case ignored)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def doc_bucket(column, buckets):
    """crc32 of the id as text, modulo ``buckets``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % buckets


def steps(batches, column, limit=STEP_BYTES):
    """The batches cut so that ``column`` holds at most ``limit`` bytes in each
    part, or a single row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        begin = held = 0
        for i, size in enumerate(sizes):
            if i > begin and held + size > limit:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += size
        if begin < len(sizes):
            yield batch.slice(begin)


def as_bytes(array):
    """A string column as Python bytes, null as ``None``."""
    return array.cast(pa.binary()).to_pylist()
