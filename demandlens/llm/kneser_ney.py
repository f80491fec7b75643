"""A quality classifier: interpolated modified Kneser-Ney over byte n-grams.

The model is fitted on all trusted texts but those left out for the quantiles. Counts,
continuation counts, discounts and the joins of each order with its contexts and its next
lower order are Spark jobs; an n-gram is a whole number, its bytes. The finished table (log
probability of each seen n-gram, weight of each seen context) grows with the texts and stays
a Spark table: the different n-grams of a chunk of texts are packed and sent to the shards
of the model, which are cut by the last bytes of the context, so that all an n-gram needs is
in one shard; the values come back to the chunk. Only orders 1 and 2, which are of fixed
size, are broadcast. Each text gets its perplexity, and is kept between two quantiles of the
trusted texts of its language; the upper one is taken from those that were left out of the
fit.
"""

from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from demandlens.llm.frames import bucketed, doc_bucket, fresh, steps, stored
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructType

ORDER = 6
MAX_LANGUAGES = 500
#: Bytes of a shard, of the model or of the n-grams sent to it, at 20 a row.
SHARD_BYTES, ROW_BYTES = 32 << 20, 20
#: Into how many shards the third last byte of the context divides those of the last two.
THIRDS = 16
#: Text whose different n-grams are looked up together, and text that is packed together.
CHUNK_BYTES, PART_BYTES = 32 << 20, 2 << 20
#: One trusted document in so many is left out of the fit, for the quantiles.
HELD_OUT = 5
LOW, HIGH = 0.002, 0.99
#: How far beyond its quantiles a language still keeps texts.
SLACK = 1.2
#: Texts left out of the fit that a language's own quantiles need.
FEW = 50
ACCURACY = 10_000
#: Bits of the map of trusted ids, 8 MB.
ID_BITS = 1 << 26


def grams(texts):
    """(n-gram ending at each byte, text of each byte): ``ORDER`` bytes, zeros before the
    start of a text. Null as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data else np.empty(0, np.uint8)
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    since = np.arange(len(raw)) - np.repeat(bounds[:-1] - bounds[0], sizes)
    key = raw.astype(np.int64)
    for k in range(1, ORDER):
        before = np.zeros(len(raw), np.int64)
        before[k:] = raw[:-k]
        before[since < k] = 0
        key |= before << (8 * k)
    return key, owner


def counted(docs, text):
    """(gram, a): how often each n-gram of the highest order occurs."""
    def each(batches):
        for part in steps(batches, "text"):
            key, n = np.unique(grams(part.column("text"))[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n, pa.int64())], names=["gram", "n"])

    rows = docs.select(F.col(text).alias("text")).mapInArrow(each, "gram long, n long")
    return rows.groupBy("gram").agg(F.sum("n").alias("a"))


def discounts(table):
    """The three discounts of an order from its numbers of counts 1 to 4."""
    n = {r["c"]: r["n"] for r in table.where("a <= 4").groupBy(F.col("a").alias("c")).agg(F.count("*").alias("n")).collect()}
    n = [n.get(i, 0) for i in range(5)]
    if not n[1] or not n[2]:
        return [0.5, 0.75, 1.0]
    y = n[1] / (n[1] + 2 * n[2])
    return [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.0), float(i)) if n[i] else float(i) * 0.5 for i in (1, 2, 3)]


def fit(docs, text="text"):
    """The finished table: order, gram, value. Order k in 1..ORDER has log probabilities of
    n-grams, order -k the log weights of contexts of k bytes (k = 0 .. ORDER - 1)."""
    levels = [stored(counted(docs, text), "grams")]
    for k in range(ORDER - 1, 0, -1):  # how many different bytes come before each shorter n-gram
        shorter = levels[0].groupBy(F.col("gram").bitwiseAND((1 << (8 * k)) - 1).alias("gram")).agg(F.count("*").alias("a"))
        levels.insert(0, stored(shorter, "grams"))
    out, lower = None, None
    for k, level in enumerate(levels, 1):
        d = discounts(level)
        mine = F.when(F.col("a") == 1, d[0]).when(F.col("a") == 2, d[1]).otherwise(d[2])
        context = F.shiftright("gram", 8).alias("context")
        stats = level.groupBy(context).agg(F.sum("a").alias("total"), F.sum(mine).alias("taken"))
        share = level.select("gram", context, F.greatest(F.col("a") - mine, F.lit(0.0)).alias("left")).join(stats, "context")
        share = share.withColumn("weight", F.col("taken") / F.col("total"))
        if lower is None:
            seen = share.select("gram", (F.col("left") / F.col("total") + F.col("weight") / 256).alias("p"))
        else:
            tail = lower.select(F.col("gram").alias("tail"), F.col("p").alias("q"))
            seen = (share.join(tail, F.col("gram").bitwiseAND((1 << (8 * (k - 1))) - 1) == F.col("tail"))
                    .select("gram", (F.col("left") / F.col("total") + F.col("weight") * F.col("q")).alias("p")))
        lower = stored(seen, "order")
        part = lower.select(F.lit(k).alias("order"), "gram", F.log("p").alias("value")).union(
            stats.select(F.lit(1 - k), "context", F.log(F.col("taken") / F.col("total"))))
        out = part if out is None else out.union(part)
    return stored(out, "model")


class Shard:
    """Sorted tables of a part of a model, by order."""

    def __init__(self, rows, more=None):
        order = rows["order"].to_numpy()
        gram, value = rows["gram"].to_numpy(), rows["value"].to_numpy().astype(np.float32)
        self.tables = dict(more.tables) if more else {}
        for k in np.unique(order).tolist():
            own = order == k
            by = np.argsort(gram[own])
            self.tables[k] = gram[own][by], value[own][by]

    def find(self, order, keys):
        """(present, value) of each key at an order."""
        if order not in self.tables:
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.float32)
        gram, value = self.tables[order]
        at = np.minimum(np.searchsorted(gram, keys), len(gram) - 1)
        return gram[at] == keys, value[at]

    def log_probability(self, keys):
        """ln p of the last byte of each n-gram: from the longest seen suffix, times the
        weights of the longer contexts."""
        total = np.zeros(len(keys))
        rest = np.arange(len(keys))
        for k in range(ORDER, 0, -1):
            own = keys[rest] & ((1 << (8 * k)) - 1)
            seen, value = self.find(k, own)
            total[rest[seen]] += value[seen]
            rest = rest[~seen]
            known, weight = self.find(1 - k, own[~seen] >> 8)
            total[rest] += np.where(known, weight, 0)
        total[rest] -= np.log(256)
        return total


def packed(values):
    """Numbers as compressed byte planes."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpacked(data, size, kind):
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, size * width, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, size).T).view(kind).reshape(size)


def packed_grams(keys):
    """Sorted n-grams as packed differences."""
    return packed(np.diff(keys, prepend=0))


def unpacked_grams(data, size):
    return np.cumsum(unpacked(data, size, np.int64))


def chunks(docs, text):
    """All rows of ``docs``, packed, and the different n-grams of each chunk of them: chunk,
    rows (an Arrow stream) or n and grams."""
    schema = StructType().add("chunk", "long").add("rows", "binary").add("n", "long").add("grams", "binary")

    def row(chunk, rows, n, found):
        return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([rows], pa.binary()),
                                           pa.array([n], pa.int64()), pa.array([found], pa.binary())], names=schema.names)

    def each(batches):
        chunk, held, found = TaskContext.get().partitionId() << 32, 0, np.empty(0, np.int64)
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            for part in steps([batch], text, PART_BYTES):
                keys = grams(part.column(text))[0]
                if held and held + len(keys) > CHUNK_BYTES:
                    yield row(chunk, None, len(found), packed_grams(found))
                    chunk, held, found = chunk + 1, 0, np.empty(0, np.int64)
                held += len(keys)
                found = np.union1d(found, np.unique(keys))
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=options) as stream:
                    stream.write_batch(part)
                yield row(chunk, sink.getvalue().to_pybytes(), None, None)
        if held:
            yield row(chunk, None, len(found), packed_grams(found))

    return docs.mapInArrow(each, schema)


def answers(table, model):
    """(chunk, n, grams, value): the log probabilities of the n-grams of each chunk."""
    most = max(model.count(), table.agg(F.sum("n")).first()[0] or 0)
    count = max(1, ceil(most * ROW_BYTES / SHARD_BYTES))
    thirds = min(THIRDS, count)
    pairs = ceil(count / thirds) | 1
    context = F.when(F.col("order") > 0, F.shiftright("gram", 8)).otherwise(F.col("gram"))
    size = F.when(F.col("order") > 0, F.col("order") - 1).otherwise(-F.col("order"))  # bytes of the context
    third = (F.shiftright(context, 16).bitwiseAND(255) % thirds).cast("int")
    every = F.sequence(F.lit(0), F.lit(thirds - 1))  # a context of two bytes is in all shards of these
    longer = (model.where(size >= 2).select("*", F.explode(F.when(size == 2, every).otherwise(F.array(third))).alias("third"))
              .select((context.bitwiseAND(65535) % pairs * thirds + F.col("third")).alias("shard"), "order", "gram", "value"))
    shorter = Shard(model.where(size < 2).toArrow())  # at most 65,536 + 2 * 256 + 1 rows
    shared = table.sparkSession.sparkContext.broadcast(shorter)

    def ask(batches):
        for batch in batches:
            for chunk, n, data in zip(*(batch.column(c).to_pylist() for c in ("chunk", "n", "grams"))):
                keys = unpacked_grams(data, n)
                at = keys >> 8
                shard = (at & 65535) % pairs * thirds + ((at >> 16) & 255) % thirds
                order = np.argsort(shard, kind="stable")
                numbers, first = np.unique(shard[order], return_index=True)
                parts = np.split(keys[order], first[1:])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers, pa.int64()), pa.array([chunk] * len(parts), pa.int64()),
                     pa.array([len(x) for x in parts], pa.int64()),
                     pa.array([packed_grams(x) for x in parts], pa.binary())], names=["shard", "chunk", "n", "grams"])

    asked = table.where("n > 0").select("chunk", "n", "grams").mapInArrow(
        ask, "shard long, chunk long, n long, grams binary")

    def answer(rows, asked):
        shard = Shard(rows, shared.value)
        value = [packed(shard.log_probability(unpacked_grams(data.as_py(), n.as_py())).astype(np.float32))
                 for n, data in zip(asked["n"], asked["grams"])]
        return pa.table({"chunk": asked["chunk"], "n": asked["n"], "grams": asked["grams"],
                         "value": pa.array(value, pa.binary())})

    return longer.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(
        answer, "chunk long, n long, grams binary, value binary")


def perplexities(docs, model, text="text", names=("n_bytes", "perplexity")):
    """``docs`` plus the number of bytes of ``text`` and its perplexity per byte; null and
    empty texts have 0 and null. ``names`` get leading underscores where ``docs`` has such
    columns."""
    size = fresh(docs.columns, names[0])
    result = fresh([*docs.columns, size], names[1])
    total = fresh([*docs.columns, size, result], "total")
    schema = StructType(list(docs.schema.fields)).add(total, DoubleType()).add(size, LongType())
    table = bucketed(chunks(docs, text), "chunks", "chunk")  # the packed texts stay where they are

    def settle(rows, found):
        pairs = [(unpacked_grams(g.as_py(), n.as_py()), unpacked(v.as_py(), n.as_py(), np.float32))
                 for n, g, v in zip(found["n"], found["grams"], found["value"])]
        keys = np.concatenate([np.empty(0, np.int64), *(g for g, _ in pairs)])
        value = np.concatenate([np.empty(0, np.float32), *(v for _, v in pairs)])
        order = np.argsort(keys)
        keys, value, out = keys[order], value[order], []
        for data in rows["rows"]:
            for part in pa.ipc.open_stream(data.as_py()):
                own, owner = grams(part.column(text))
                some, back = np.unique(own, return_inverse=True)
                sums = np.bincount(owner, value[np.searchsorted(keys, some)][back], part.num_rows).astype(float)
                out.append(pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(sums, pa.float64()),
                     pa.array(np.bincount(owner, minlength=part.num_rows), pa.int64())], names=schema.names))
        return pa.Table.from_batches(out)

    rows = table.where("rows IS NOT NULL").select("chunk", "rows")
    scored = rows.groupBy("chunk").cogroup(answers(table, model).groupBy("chunk")).applyInArrow(settle, schema)
    return scored.withColumn(result, F.when(F.col(size) > 0, F.exp(-F.col(total) / F.col(size)))).drop(total)


def likely_among(docs, ids, key="doc"):
    """The rows of ``docs`` whose ``key`` may be among ``ids``: those whose hash has its bit
    set. All that are among them pass, so a join on the ids behind it gives the same rows
    and shuffles few others."""
    if docs.schema[key].dataType != ids.schema[key].dataType:
        return docs  # equal ids of two types may have two hashes
    place = F.pmod(F.xxhash64(key), F.lit(ID_BITS))
    bucket, at = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    bits = ids.where(F.col(key).isNotNull()).groupBy(bucket.alias("_bucket")).agg(F.bitmap_construct_agg(at).alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.floor(byte / F.pow(F.lit(2), at % 8)) % 2
    return docs.join(F.broadcast(bits), bucket == F.col("_bucket")).where(bit == 1).select(*docs.columns)  # 8 MB at most


def classify(docs, labels, doc_id="doc_id", text="text", lang="lang", quality="quality"):
    """One row per row of ``docs``: doc, lang, n_bytes, perplexity, low, high, kept.

    Trusted are the documents that ``labels`` gives quality 1. A document is kept if its
    perplexity is at least the ``LOW`` quantile of the trusted documents of its language, those
    of the fit included (the model knows them, and copies of them, by heart), and at most the
    ``HIGH`` quantile of those that were left out of the fit, both widened by ``SLACK``. A
    language with fewer than ``FEW`` of the latter takes the wider of its own bounds and those over
    all languages, a language without trusted documents (or a null one) the latter. Empty texts are not kept; without
    any trusted document nothing is judged and everything else is kept.
    """
    trusted = labels.where(F.col(quality) == 1).select(F.col(doc_id).alias("doc")).distinct()
    table = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    out = doc_bucket("doc", HELD_OUT) == 0
    if table.select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages; raise MAX_LANGUAGES or merge labels")
    # an inner join on different ids: a semi join would be moved in front of the bitmap
    model = fit(likely_among(table.where(~out), trusted).join(trusted, "doc"), "text")
    judged = stored(perplexities(table, model).select("doc", "lang", "n_bytes", "perplexity"), "perplexities")
    known = judged.join(trusted, "doc", "left_semi").where("perplexity IS NOT NULL")
    left_out = F.when(out, F.col("perplexity"))
    figures = [F.percentile_approx("perplexity", LOW, ACCURACY).alias("low"),
               F.percentile_approx(left_out, HIGH, ACCURACY).alias("high"), F.count(left_out).alias("n")]
    every = known.agg(*figures).first()
    least, most = every["low"] or 0.0, every["high"] or float("inf")
    low, high = F.lit(least / SLACK), F.lit(most * SLACK)
    for row in known.groupBy("lang").agg(*figures).collect():
        if row["lang"] is not None:
            own_low, own_high = row["low"], row["high"] if row["high"] is not None else most
            if row["n"] < FEW:
                own_low, own_high = min(own_low, least), max(own_high, most)
            low = F.when(F.col("lang") == row["lang"], own_low / SLACK).otherwise(low)
            high = F.when(F.col("lang") == row["lang"], own_high * SLACK).otherwise(high)
    judged = judged.withColumn("low", low).withColumn("high", high)
    return judged.withColumn("kept", F.coalesce(F.col("perplexity").between(F.col("low"), F.col("high")), F.lit(False)))
