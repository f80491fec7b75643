"""Near-duplicate documents by HyperMinHash registers.

A document is the set of 64-bit hashes of its word shingles. The first ``P`` bits of a
hash choose one of 2**P buckets; a bucket keeps the smallest remainder in compressed form,
as its count of leading zeros and the next ``MANTISSA`` bits, in 16 bits. Bands of
registers find candidates, the share of equal registers, corrected for accidental
equality, drops most wrong ones, and the full sets decide.

Documents with the same set are one class from the start (copies are never paired), and a
class meets only the smallest class of each band bucket, so a bucket of any size costs one
pair per member. After that, in buckets whose members are still in several components, the
members outside the main one are compared with the whole bucket: as pairs in small buckets,
else in blocks that stay inside a task and give one row per link found; see ``linked``.
"""

import numpy as np
import pyarrow as pa
import xxhash
from demandlens.llm.components import components
from demandlens.llm.frames import steps, stored
from demandlens.llm.words import STEP, Words, mix
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StructType

#: Register layout: 2**P buckets, MANTISSA bits after the first one bit.
P, MANTISSA = 8, 10
#: Bands of ROWS registers. At similarity 0.8 a pair misses all bands with
#: probability (1 - 0.8**6)**42, about 3 in a million.
ROWS, BANDS = 6, 42
LEAST_PERCENT = 80
#: Standard deviations that the estimate may fall short of the threshold.
MARGIN = 5
#: Buckets up to this size are settled by pairs, larger ones in blocks.
SMALL = 16
#: Sets that a task holds of the one side of a block, and streams past them.
HELD, STREAMED = 256, 2_048
PAIRS_IN_FLIGHT, SETS_IN_FLIGHT = 2_000, 256

BUCKETS = 1 << P
REST = 64 - P
_SALT = mix(np.arange(1, BUCKETS + 65, dtype=np.uint64) * STEP) | np.uint64(1)


def shingle_sets(words, size):
    """The sorted different shingle hashes of each document; a document with fewer words
    than ``size`` has its whole sequence as one shingle, without words none."""
    h = words.hashes()
    n = max(0, len(h) - size + 1)
    whole = np.zeros(n, np.uint64)
    for k in range(size):
        whole += h[k:k + n] * _SALT[k]
    whole = mix(whole)
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= size:
            yield np.unique(whole[a:b - size + 1])
        elif b > a:
            short = (h[a:b] * _SALT[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            yield mix(np.atleast_1d(short))
        else:
            yield h[:0]


def registers(sets):
    """A row of 2**P registers per set; 0 marks an empty bucket.

    The sets are sorted, so the first hash with given first ``P`` bits is the smallest."""
    out = np.zeros((len(sets), BUCKETS), np.uint16)
    lengths = np.array([len(s) for s in sets], np.int64)
    if not lengths.sum():
        return out
    values = np.concatenate(sets)
    slot = np.repeat(np.arange(len(sets)), lengths) * BUCKETS + (values >> np.uint64(REST)).astype(np.int64)
    at = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
    least = values[at] & np.uint64((1 << REST) - 1)
    zeros = REST - np.frexp(least.astype(np.float64))[1]
    zeros = np.clip(zeros, 0, REST)
    shift = np.minimum(zeros + P + 1, 63).astype(np.uint64)
    mantissa = (least << shift) >> np.uint64(64 - MANTISSA)
    out.reshape(-1)[slot[at]] = zeros * (1 << MANTISSA) + mantissa.astype(np.int64) + 1
    return out


def dense(regs):
    """Empty buckets copy the first filled bucket of a fixed probe sequence of their own,
    so that equality of two sets' registers stays about as likely as their similarity."""
    out, filled = regs.copy(), regs > 0
    rows = np.flatnonzero(filled.any(axis=1) & ~filled.all(axis=1))
    open_rows, open_at = np.nonzero(~filled[rows])
    open_rows = rows[open_rows]
    attempt = 1
    while len(open_rows):
        probe = (mix(open_at.astype(np.uint64) * STEP + np.uint64(attempt)) >> np.uint64(REST)).astype(np.int64)
        hit = filled[open_rows, probe]
        out[open_rows[hit], open_at[hit]] = regs[open_rows[hit], probe[hit]]
        open_rows, open_at = open_rows[~hit], open_at[~hit]
        attempt += 1
    return out


def band_keys(regs):
    """One 64-bit key per band of densified registers."""
    parts = dense(regs)[:, :ROWS * BANDS].astype(np.uint64).reshape(-1, BANDS, ROWS)
    keys = (parts * _SALT[:ROWS]).sum(axis=2, dtype=np.uint64)
    return mix(keys + _SALT[np.newaxis, 64:64 + BANDS]).view(np.int64)


def estimate(a, na, b, nb):
    """(similarity, buckets used): the share of equal registers among those filled in
    either set, less the equality to be expected between unrelated sets of these sizes."""
    used = ((a > 0) | (b > 0)).sum(axis=1)
    same = ((a == b) & (a > 0)).sum(axis=1)
    n, m = np.maximum(na, nb).astype(float), np.minimum(na, nb).astype(float)
    ratio = 4 * (n / m) / ((1 + n) / m) ** 2
    chance = 0.169919487159739 * 2.0 ** (P - MANTISSA) * np.minimum(ratio, 1)
    return np.clip((same - chance) / np.maximum(used, 1), 0, 1), used


def signatures(docs, size, doc_id="doc_id", text="text"):
    """Per document row: doc, n (set size), node (digest of the set), regs and bands.

    ``bands`` is empty below four shingles: there only equal sets can be similar enough
    for a threshold of 0.8, and equal sets share their node. ``node`` is null for an
    empty set.
    """
    wanted = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    schema = (StructType([wanted.schema["doc"]]).add("n", LongType()).add("node", BinaryType())
              .add("regs", BinaryType()).add("bands", ArrayType(LongType())))

    def each(batches):
        for part in steps(batches, "text"):
            sets = list(shingle_sets(Words(part.column("text")), size))
            regs = registers(sets)
            bands = np.zeros((len(sets), BANDS), np.int64)
            wide = np.array([len(s) > 3 for s in sets], bool)
            bands[wide] = band_keys(regs[wide])
            offsets = np.concatenate([[0], np.cumsum(wide * BANDS)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                part.column("doc"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.array([r.tobytes() for r in regs], pa.binary()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands[wide].reshape(-1)))],
                names=schema.names)

    return wanted.mapInArrow(each, schema)


def full_sets(docs, size, doc_id="doc_id", text="text"):
    """(node, members): the sorted shingle hashes of each document row."""
    schema = StructType().add("node", BinaryType()).add("members", BinaryType())

    def each(batches):
        for part in steps(batches, "text"):
            sets = [s for s in shingle_sets(Words(part.column("text")), size) if len(s)]
            yield pa.RecordBatch.from_arrays([
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.array([s.tobytes() for s in sets], pa.binary())], names=schema.names)

    return docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).mapInArrow(each, schema)


def promising(pairs, classes, percent):
    """The (u, v) pairs that may reach ``percent`` by size and by estimate, with it."""
    left = classes.select(F.col("node").alias("u"), F.col("n").alias("nu"), F.col("regs").alias("ru"))
    right = classes.select(F.col("node").alias("v"), F.col("n").alias("nv"), F.col("regs").alias("rv"))
    both = (pairs.join(left, "u").join(right, "v")
            .where(100 * F.least("nu", "nv") >= percent * F.greatest("nu", "nv")))
    schema = StructType().add("u", BinaryType()).add("v", BinaryType()).add("near", DoubleType())

    def each(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, PAIRS_IN_FLIGHT):
                part = batch.slice(begin, PAIRS_IN_FLIGHT)
                a, b = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS)
                        for c in ("ru", "rv"))
                near, used = estimate(a, part.column("nu").to_numpy(), b, part.column("nv").to_numpy())
                slack = MARGIN * np.sqrt(percent * (100 - percent)) / 100 / np.sqrt(np.maximum(used, 1))
                keep = pa.array(near >= percent / 100 - slack)
                yield pa.RecordBatch.from_arrays(
                    [part.column("u"), part.column("v"), pa.array(near)], names=schema.names).filter(keep)

    return both.select("u", "ru", "nu", "v", "rv", "nv").mapInArrow(each, schema)


def confirmed(pairs, sets, percent):
    """The (u, v) pairs whose full sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("node").alias("u"), F.col("members").alias("su"))
    right = sets.select(F.col("node").alias("v"), F.col("members").alias("sv"))
    schema = StructType().add("u", BinaryType()).add("v", BinaryType())

    def each(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("su"), batch.column("sv")):
                a, b = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                small, large = (a, b) if len(a) <= len(b) else (b, a)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum())
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column("u"), batch.column("v")], names=schema.names).filter(pa.array(keep, pa.bool_()))

    return (pairs.select("u", "v").join(left, "u").join(right, "v")
            .select("u", "v", "su", "sv").mapInArrow(each, schema))


def linked(docs, classes, members, size, percent, doc_id, text):
    """(node, root) of all classes that have a link.

    ``members`` has (key, node) for band buckets of two classes or more. First each member
    is paired with the smallest node of its buckets, and each class's best pair is
    confirmed; the other pairs matter only where they would join components. Then every
    bucket with members of several components is settled: all pairs between a member
    outside its largest component and any other member are compared, so two similar classes
    that share a bucket end up together whatever the bucket's size.
    """
    nodes = members.select("node").distinct()
    owners = classes.join(nodes, "node", "left_semi").select(F.col("doc").alias("own"))
    near_docs = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    near_docs = near_docs.join(owners.distinct(), F.col("doc").eqNullSafe(F.col("own")), "left_semi")
    sets = stored(full_sets(near_docs, size, "doc", "text").join(nodes, "node", "left_semi")
                  .dropDuplicates(["node"]), "sets")

    hubs = members.groupBy("key").agg(F.min("node").alias("hub"))
    pairs = (members.join(hubs, "key").where("node <> hub")
             .select(F.col("node").alias("u"), F.col("hub").alias("v")).distinct())
    tried = stored(promising(pairs, classes, percent), "candidates")
    best = tried.groupBy("u").agg(F.max_by("v", F.struct("near", "v")).alias("v"))
    roots = grown(None, confirmed(best, sets, percent))
    rest = across(tried.join(best, ["u", "v"], "left_anti"), roots)
    roots = grown(roots, confirmed(rest, sets, percent))

    inside = stored(unsettled(members, roots), "unsettled")
    small = promising(small_pairs(inside).join(tried.select("u", "v"), ["u", "v"], "left_anti"), classes, percent)
    blocks = block_links(inside.where(F.col("total") > SMALL), sets, percent)
    return grown(roots, confirmed(small, sets, percent).union(blocks))


def grown(roots, edges):
    """(node, root) after adding edges (u, v) to known components (``None``: no one yet)."""
    if roots is not None:
        edges = roots.select(F.col("node").alias("u"), F.col("root").alias("v")).union(edges)
    return stored(components(edges, SETS_IN_FLIGHT), "roots")


def with_root(rows, roots, node, name):
    """``rows`` plus the root of column ``node``; a node without links is its own root."""
    own = roots.select(F.col("node").alias(node), F.col("root").alias(name))
    return rows.join(own, node, "left").withColumn(name, F.coalesce(name, node))


def across(pairs, roots):
    """The (u, v) pairs whose ends have different roots."""
    return (with_root(with_root(pairs, roots, "u", "root_u"), roots, "v", "root_v")
            .where("root_u <> root_v").select("u", "v"))


def unsettled(members, roots):
    """The members of buckets that reach over several components: key, node, root, the
    bucket's largest component ``main``, its size ``total`` and how many are ``outside``
    of main."""
    placed = with_root(members, roots, "node", "root")
    by_root = placed.groupBy("key", "root").agg(F.count("*").alias("size"))
    several = (by_root.groupBy("key").agg(F.count("*").alias("roots"), F.sum("size").alias("total"),
                                          F.max(F.struct("size", "root")).alias("main"))
               .where("roots > 1").select("key", F.col("main.root").alias("main"), "total",
                                          (F.col("total") - F.col("main.size")).alias("outside")))
    return placed.join(several, "key")


def small_pairs(inside):
    """The (u, v) pairs between components within buckets of at most ``SMALL``: not more
    than that many per member."""
    few = inside.where(F.col("total") <= SMALL)
    outer = few.where("root <> main").select("key", F.col("node").alias("a"), F.col("root").alias("ra"))
    whole = few.select("key", F.col("node").alias("b"), F.col("root").alias("rb"))
    return (outer.join(whole, "key").where("ra <> rb")
            .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())


def block_links(inside, sets, percent):
    """Links between components in large buckets, one per member, component and block.

    A bucket is cut into blocks of about ``HELD`` members outside the main component by
    ``STREAMED`` members of any kind. Each block is one sorted run in a task, which indexes
    the first and streams the others past them, comparing full sets.
    """
    def pieces(total, each):
        return F.ceil(total / F.lit(each)).cast("int")

    rows = (inside.withColumn("chunks", pieces(F.col("outside"), HELD))
            .withColumn("salts", pieces(F.col("total"), STREAMED)))
    draw = F.xxhash64("node")
    held = (rows.where("root <> main").withColumn("chunk", F.pmod(draw, "chunks").cast("int"))
            .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).withColumn("role", F.lit(0)))
    passing = (rows.withColumn("salt", F.pmod(draw, "salts").cast("int"))
               .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn("role", F.lit(1)))
    columns = ["key", "chunk", "salt", "role", "node", "root"]
    blocks = (held.select(*columns).union(passing.select(*columns)).join(sets, "node")
              .repartition("key", "chunk", "salt").sortWithinPartitions("key", "chunk", "salt", "role"))
    schema = StructType().add("u", BinaryType()).add("v", BinaryType())

    def each(batches):
        block, index, seen = None, None, set()
        for batch in batches:
            u, v = [], []
            for key, chunk, salt, role, node, root, members in zip(*(c.to_pylist() for c in batch.columns)):
                if block != (key, chunk, salt):
                    block, index, seen = (key, chunk, salt), Index(), set()
                own = np.frombuffer(members, np.uint64)
                if role == 0:
                    index.add(node, root, own)
                    continue
                for at in index.similar(own, percent):
                    link = (index.nodes[at], root)
                    if index.roots[at] != root and link not in seen:
                        seen.add(link)
                        u.append(index.nodes[at])
                        v.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())], names=schema.names)

    return blocks.select(*columns, "members").mapInArrow(each, schema)


class Index:
    """The sets held of a block, by shingle."""

    def __init__(self):
        self.nodes, self.roots, self.sets, self.ready = [], [], [], False

    def add(self, node, root, members):
        self.nodes.append(node)
        self.roots.append(root)
        self.sets.append(members)

    def similar(self, members, percent):
        """The places of the held sets that are similar enough to ``members``."""
        if not self.sets:
            return []
        if not self.ready:
            self.sizes = np.array([len(s) for s in self.sets])
            every = np.concatenate(self.sets)
            order = np.argsort(every, kind="stable")
            self.shingles, self.owner = every[order], np.repeat(np.arange(len(self.sets)), self.sizes)[order]
            self.ready = True
        low = np.searchsorted(self.shingles, members, "left")
        width = np.searchsorted(self.shingles, members, "right") - low
        at = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width) + np.repeat(low, width)
        both = np.bincount(self.owner[at], minlength=len(self.sizes))
        return np.flatnonzero(100 * both >= percent * (self.sizes + len(members) - both)).tolist()


def near_duplicates(docs, size=5, percent=80, doc_id="doc_id", text="text"):
    """One row per row of ``docs``: doc, n_shingles, component, kept.

    ``component`` is the smallest id reachable over links, itself included; ``kept`` says
    whether the row's id is that one. Rows with equal sets are linked. Null text and text
    without words have no shingles and are linked with nothing. Ids may repeat (each row
    is answered for itself) or be null (such a row takes the smallest known id of its
    component, null if there is none, and is kept only then). No rows in, no rows out. The
    bands find pairs of 80 percent and more; a lower ``percent`` is refused.
    """
    if percent < LEAST_PERCENT:
        raise ValueError(f"the bands are laid out for {LEAST_PERCENT} percent and more")
    signed = stored(signatures(docs, size, doc_id, text), "signatures")
    classes = (signed.where("node IS NOT NULL").groupBy("node")
               .agg(F.min("doc").alias("doc"), F.count("*").alias("copies"), F.first("n").alias("n"),
                    F.first("regs").alias("regs"), F.first("bands").alias("bands")))
    classes = stored(classes, "classes")
    keys = classes.select("node", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key")
    members = stored(keys.join(shared, "key"), "members")
    roots = linked(docs, classes, members, size, percent, doc_id, text)
    placed = with_root(classes.select("node", "doc", "copies"), roots, "node", "root")
    smallest = placed.join(roots.select("root").distinct(), "root", "left_semi").groupBy("root").agg(
        F.min("doc").alias("component"))
    grouped = (placed.join(smallest, "root", "left").where("copies > 1 OR component IS NOT NULL")
               .select("node", F.coalesce("component", "doc").alias("component")))
    out = signed.select("doc", "n", "node").join(grouped, "node", "left")
    component = F.coalesce("component", "doc")
    return out.select("doc", F.col("n").alias("n_shingles"), component.alias("component"),
                      F.col("doc").eqNullSafe(component).alias("kept"))


def deduplicate(docs, size=5, percent=80, doc_id="doc_id", text="text"):
    """``docs`` with one document of each group of near duplicates: the smallest id."""
    kept = near_duplicates(docs, size, percent, doc_id, text).where("kept")
    names = kept.select(F.col("doc").alias("kept_doc")).distinct()
    return docs.join(names, docs[doc_id].eqNullSafe(names["kept_doc"]), "left_semi")
