"""Line dedup by levelled sorted runs of line hashes.

A run is a table (key, docs, last) sorted by key: in how many documents of its batch a line
key occurs and the largest document id that holds it. Each new batch is merge-anti-joined
with the live runs, and what no run holds becomes a run of its own; so a key lives in one run
only. What the runs do hold is kept apart as repeats, to be added at the end. When a level
has ``fanout`` runs they are compacted into one run of the next level, so a line is rewritten
once per level. Nothing but hashes and ids is joined or sorted; the texts move once, to meet
the list of lines that they lose.

Keys are 128-bit hashes of the stripped, lower-cased line.
"""

from functools import reduce

import pyarrow as pa
import xxhash
from demandlens.llm.frames import BLANKS, as_bytes, fresh, steps, stored
from demandlens.session import scratch_path
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType

MIN_POINTS = 20
MIN_DOCS = 3
BATCHES = 3
FANOUT = 2
#: A line with more than one in so many (document, line) pairs is hot.
HOT = 1_000
STRIP = BLANKS.encode()


def line_key(line, min_points):
    """The hash of a line's key, or ``None`` where the key is too short."""
    key = line.strip(STRIP).lower()
    size = len(key)
    if size < min_points or (size < 4 * min_points and not key.isascii()
                             and len(key.decode()) < min_points):
        return None
    return xxhash.xxh3_128_digest(key)


def line_keys(docs, doc_id="doc_id", text="text", min_points=MIN_POINTS):
    """One row (doc, key) per document row and different line key."""
    wanted = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    schema = wanted.select("doc").schema.add("key", BinaryType())

    def each(batches):
        for part in steps(batches, "text"):
            rows, keys = [], []
            for i, value in enumerate(as_bytes(part.column("text"))):
                own = {line_key(line, min_points) for line in (value or b"").split(b"\n")} - {None}
                rows += [i] * len(own)
                keys += own
            yield pa.RecordBatch.from_arrays(
                [part.column("doc").take(pa.array(rows, pa.int64())), pa.array(keys, pa.binary())],
                names=["doc", "key"])

    return wanted.mapInArrow(each, schema)


class LineRuns:
    """The runs of all levels, as sorted tables in the shared folder, and the repeats."""

    def __init__(self, spark, fanout=FANOUT):
        self.spark, self.fanout, self.levels, self.repeats = spark, fanout, [], []

    def _write(self, run, level):
        path = scratch_path(self.spark, f"lines-level{level}")
        (run.repartitionByRange("key").sortWithinPartitions("key").write.parquet(path))
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    def runs(self):
        return [p for level in self.levels for p in level]

    def read(self):
        """All live runs, one row per key; ``None`` before the first batch."""
        paths = self.runs()
        return self.spark.read.parquet(*paths) if paths else None

    def new_keys(self, rows):
        """The rows with a key that no live run holds."""
        known = self.read()
        return rows if known is None else rows.join(known.select("key").hint("merge"), "key", "left_anti")

    def add(self, rows):
        """Add a batch of (doc, key) rows. A document must not return in a later batch."""
        once = rows.groupBy("key", "doc").agg(F.lit(1).alias("one"))
        own = stored(once.groupBy("key").agg(F.count("one").alias("docs"), F.max("doc").alias("last")), "line-batch")
        known = self.read()
        if known is not None:
            self.repeats.append(stored(own.join(known.select("key").hint("merge"), "key", "left_semi"), "line-repeats"))
        self._write(self.new_keys(own), 0)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._write(self.spark.read.parquet(*full), level + 1)
            level += 1

    def compacted(self, least=1):
        """One row per key that ``least`` documents hold, over all runs and repeats."""
        alone = self.read()
        if not self.repeats:
            return alone.where(F.col("docs") >= least)
        again = reduce(DataFrame.union, self.repeats).groupBy("key").agg(
            F.sum("docs").alias("more"), F.max("last").alias("later"))
        both = alone.join(again, "key", "left")
        docs = F.col("docs") + F.coalesce("more", F.lit(0))
        return both.where(docs >= least).select("key", docs.alias("docs"), F.greatest("last", "later").alias("last"))


def dedup_lines(docs, doc_id="doc_id", text="text", min_points=MIN_POINTS, min_docs=MIN_DOCS,
                batches=BATCHES, fanout=FANOUT, counts=("n_lines", "n_dropped")):
    """``docs`` with repeated lines taken out of ``text``, plus two counts.

    A key of ``min_points`` code points or more that at least ``min_docs`` documents hold
    loses all its lines except in the largest document id that holds it. Rows with the
    same id are one document for counting. A null id counts as one document below all
    others. Null text has one empty line and stays null. Other columns pass unchanged;
    ``counts`` names the lines before dropping and the lines dropped, and gets leading
    underscores where ``docs`` already has such a column. No rows in, no rows out.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "line-keys")
    batch = F.pmod(F.xxhash64("doc"), F.lit(batches)).alias("batch")
    line_keys(docs, doc_id, text, min_points).select("*", batch).write.partitionBy("batch").parquet(path)
    rows = spark.read.schema("doc " + dict(docs.dtypes)[doc_id] + ", key binary, batch int").parquet(path)
    runs = LineRuns(spark, fanout)
    for i in range(batches):
        runs.add(rows.where(F.col("batch") == i))
    repeated = stored(runs.compacted(min_docs), "repeated-lines")
    drops, owner = (fresh(docs.columns, n) for n in ("drops", "owner"))
    hot = F.col("docs") * HOT > rows.count()
    often = F.broadcast(repeated.where(hot))  # fewer than HOT rows
    found = rows.join(often, "key").unionByName(
        rows.join(often.select("key"), "key", "left_anti").join(repeated.where(~hot), "key"))
    lost = (found.where(~F.col("doc").eqNullSafe(F.col("last")))
            .groupBy(F.col("doc").alias(owner)).agg(F.collect_set("key").alias(drops)))
    joined = docs.join(lost, docs[doc_id].eqNullSafe(lost[owner]), "left").drop(owner)
    return without_lines(joined, text, drops, min_points, counts)


def without_lines(docs, text, drops, min_points, counts):
    """Take the lines whose key is listed in column ``drops`` out of ``text``."""
    kept = [c for c in docs.columns if c != drops]
    names = []
    for name in counts:
        names.append(fresh(kept + names, name))
    schema = docs.drop(drops).schema
    for name in names:
        schema = schema.add(name, LongType())

    def each(batches):
        for part in steps(batches, text):
            texts, total, gone = [], [], []
            for value, bad in zip(as_bytes(part.column(text)), part.column(drops).to_pylist()):
                lines = (value or b"").split(b"\n")
                bad = set(bad or ())
                stay = [x for x in lines if line_key(x, min_points) not in bad] if bad else lines
                texts.append(None if value is None else b"\n".join(stay) if bad else value)
                total.append(len(lines))
                gone.append(len(lines) - len(stay))
            texts = pa.array(texts, pa.binary()).cast(pa.string())
            columns = [texts if c == text else part.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(total, pa.int64()), pa.array(gone, pa.int64())], names=kept + names)

    return docs.mapInArrow(each, schema)
