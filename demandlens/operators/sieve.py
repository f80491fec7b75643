"""A sieve for phrases of a vocabulary of any size.

Every phrase sets one bit of a bitmap at the hash of its tokens. The bitmap has a bounded
size whatever the vocabulary, so it can be sent to every task; a run of tokens whose bit is
not set is no phrase, and only the few that pass meet the vocabulary in a join. Hashes of
tokens are made by Spark, the runs are put together from them by numpy.
"""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from ..functions.text import tokens

#: Bits per phrase, and the bounds of the whole bitmap as powers of two (8 KB to 8 MB).
BITS_PER_PHRASE, LEAST, MOST = 16, 16, 26
_ODD = np.uint64(0x9E3779B97F4A7C15)
SPANS = "array<struct<start:int,n:int>>"


def _scatter(x):
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))


def token_hashes(text):
    """A hash of every lower-cased token."""
    return F.transform(tokens(text), lambda t: F.xxhash64(F.lower(t)))


def runs(lists, lengths):
    """(n, row, start, hash) of all runs of the given numbers of tokens in lists of hashes."""
    flat = lists.flatten().to_numpy().view(np.uint64)
    row = pc.list_parent_indices(lists).to_numpy()
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    first = (np.cumsum(size) - size)[row]
    at = np.arange(len(flat))
    left = first + size[row] - at
    total = np.zeros(len(flat), np.uint64)
    for k in range(max(lengths, default=0)):
        moved = np.zeros(len(flat), np.uint64)
        moved[:max(len(flat) - k, 0)] = flat[k:]
        total = (total ^ _scatter(moved + _ODD)) * _ODD
        if k + 1 in lengths:
            keep = np.flatnonzero(left > k)
            yield k + 1, row[keep], (at - first)[keep], _scatter(total[keep])


def bitmap(phrases, text):
    """(bits as a boolean array, lengths of phrases) of the column ``text`` of a vocabulary."""
    sized = phrases.select(token_hashes(F.col(text)).alias("hashes")).where(F.size("hashes") > 0)
    lengths = {r["n"]: r["count"] for r in sized.groupBy(F.size("hashes").alias("n")).count().collect()}
    power = min(MOST, max(LEAST, math.ceil(math.log2(max(1, sum(lengths.values()) * BITS_PER_PHRASE)))))

    def each(batches):
        for batch in batches:
            lists = batch.column("hashes")
            size = pc.list_value_length(lists).to_numpy()
            for n, row, start, found in runs(lists, set(size.tolist())):
                place = (found[size[row] == n] >> np.uint64(64 - power)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(place))], names=["place"])

    places = sized.mapInArrow(each, "place long")
    words = places.groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits")).toArrow()  # at most 2**20 rows
    whole = np.zeros(1 << max(power - 6, 0), np.uint64)
    if words.num_rows:
        whole[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return np.unpackbits(whole.view(np.uint8), bitorder="little").astype(bool), sorted(lengths)


def sieved(rows, hashes, out, bits, lengths):
    """``rows`` without their column ``hashes`` and with ``out``: the runs that pass the bitmap, as
    (start, n). Rows of which nothing passes are left out."""
    kept = [c for c in rows.columns if c != hashes]
    schema = rows.drop(hashes).withColumn(out, F.lit(None).cast(SPANS)).schema
    power = int(math.log2(len(bits)))
    shared = rows.sparkSession.sparkContext.broadcast(np.packbits(bits, bitorder="little"))

    def each(batches):
        known = np.unpackbits(shared.value, bitorder="little").astype(bool)
        for batch in batches:
            found = [(n, row[hit], start[hit]) for n, row, start, key in runs(batch.column(hashes), set(lengths))
                     for hit in [known[(key >> np.uint64(64 - power)).astype(np.int64)]]]
            row = np.concatenate([r for _, r, _ in found] or [np.empty(0, np.int64)])
            start = np.concatenate([s for *_, s in found] or [np.empty(0, np.int64)])
            n = np.concatenate([np.full(len(r), n) for n, r, _ in found] or [np.empty(0, np.int64)])
            order = np.argsort(row, kind="stable")
            size = np.bincount(row, minlength=batch.num_rows)
            bounds = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
            spans = pa.ListArray.from_arrays(bounds, pa.StructArray.from_arrays(
                [pa.array(start[order].astype(np.int32)), pa.array(n[order].astype(np.int32))], names=["start", "n"]))
            part = pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], spans], names=[*kept, out])
            yield part.filter(pa.array(size > 0))

    return rows.mapInArrow(each, schema)
