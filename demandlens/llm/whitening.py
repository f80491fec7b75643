"""Embedding whitening by a covariance weighted with multiplicities.

Entries become whole numbers first, so equal vectors are exactly equal. Identical vectors
are grouped; the fit works on each distinct vector once, with its count (or one) as
weight: sums per dimension are exact, every vector is centred exactly, and each task adds
up one weighted matrix product of its block of centred vectors. The eigenvectors of the
finished dimension x dimension matrix are taken on the driver. Each distinct vector is
whitened once and joined back to the rows that hold it; vectors that are more than a
thousandth of all rows, fewer than a thousand in number, are broadcast for that, so no key
of the shuffled join is hot.
"""

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from demandlens.llm.frames import stored
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructType

SCALE, SHIFT = 1024, 100_000
#: An entry of this size or more counts as not finite.
LARGEST = float(1 << 43)
COMPONENTS = 8
#: Dimensions up to which the matrix is collected and solved on the driver.
MAX_DIMENSIONS = 4_096
#: A vector with more than one in so many rows is hot.
HOT = 1_000
#: Eigenvalues below this share of the largest, times the dimensions, count as zero.
TINY = 2.0 ** -50
STEP_BYTES = 4 << 20
_LOW = 20


def whole(table, vec_id, vector):
    """(id, x) of the rows whose vector is sound: x = floor(1024 * entry) + 100000."""
    wanted = table.select(F.col(vec_id).alias("id"), F.col(vector).alias("vector"))
    schema = StructType([wanted.schema["id"]]).add("x", ArrayType(LongType()))

    def each(batches):
        for batch in batches:
            lists = batch.column("vector")
            values = pc.cast(pc.list_flatten(lists), pa.float64())
            owner = pc.list_parent_indices(lists).to_numpy()
            missing = values.is_null().to_numpy(zero_copy_only=False)
            c = np.nan_to_num(pc.fill_null(values, np.nan).to_numpy(), nan=np.inf)
            bad = missing | ~(np.abs(c) < LARGEST)
            sound = ~lists.is_null().to_numpy(zero_copy_only=False)
            sound[owner[bad]] = False
            keep = sound[owner]
            x = np.floor(SCALE * c[keep]).astype(np.int64) + SHIFT
            size = np.bincount(owner[keep], minlength=len(lists))[sound]
            bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").filter(pa.array(sound)), pa.ListArray.from_arrays(pa.array(bounds), pa.array(x))],
                names=schema.names)

    return wanted.mapInArrow(each, schema)


def blocks(batches, dimensions):
    """(rows, x as a matrix, counts) of the distinct vectors, ``STEP_BYTES`` at a time."""
    step = max(1, STEP_BYTES // (8 * dimensions))
    for batch in batches:
        for begin in range(0, batch.num_rows, step):
            part = batch.slice(begin, step)
            yield part, part.column("x").flatten().to_numpy().reshape(-1, dimensions), part.column("copies").to_numpy()


@dataclass
class Fit:
    """n vectors with sums per dimension; the leading eigenvalues and eigenvectors (columns)
    of their covariance, and its trace."""

    n: int
    sums: list
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def centred(self, x):
        """n * x - S for each row: whole numbers, of Python where 64 bits do not hold them."""
        top = max(int(x.max()), -int(x.min()), 1) * self.n + max(map(abs, self.sums))
        if top < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def deviation(self, x):
        """Sum over dimensions of the squared (n * x - S), exact; ``None`` beyond 63 bits."""
        d = self.centred(x)
        if d.dtype == object or math.isqrt((1 << 63) // x.shape[1]) <= max(int(d.max()), -int(d.min())):
            d = d.astype(object)
        return [v if v < 1 << 63 else None for v in (d * d).sum(axis=1).tolist()]

    def whitened(self, x):
        """Centred vectors on the components, over the root of the eigenvalue; nan where a
        component has no variance."""
        centred = self.centred(x).astype(float) / self.n
        with np.errstate(divide="ignore", invalid="ignore"):
            out = centred @ self.vectors / np.sqrt(self.values)
        out[:, ~self.live()] = np.nan
        return out

    def live(self):
        return self.values > TINY * max(len(self.sums), 1) * max(self.values.max(initial=0), 0)

    def explained(self):
        return [v / self.trace if self.trace > 0 else None for v in self.values.tolist()]


def totals(vectors, dimensions, weights):
    """(n, sums per dimension), exact: high and low parts are added up apart."""
    def each(batches):
        n, high, low = 0, np.zeros(dimensions, np.int64), np.zeros(dimensions, np.int64)
        for _, x, copies in blocks(batches, dimensions):
            w = copies if weights == "counts" else np.ones_like(copies)
            n += int(w.sum())
            high += w @ (x >> _LOW)
            low += w @ (x & ((1 << _LOW) - 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dimensions)), pa.repeat(pa.scalar(n), dimensions), pa.array(high), pa.array(low)],
            names=["at", "n", "high", "low"])

    found = (vectors.mapInArrow(each, "at long, n long, high long, low long").groupBy("at")
             .agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")])
             .orderBy("at").collect())
    return int(found[0]["n"]), [(int(r["high"]) << _LOW) + int(r["low"]) for r in found]


def fitted(vectors, dimensions, components, weights):
    """The ``Fit`` of the distinct vectors (x, copies)."""
    n, sums = totals(vectors, dimensions, weights)
    centre = Fit(n, sums, np.empty(0), np.empty((dimensions, 0)), 0.0)

    def products(batches):
        total = np.zeros((dimensions, dimensions))
        for _, x, copies in blocks(batches, dimensions):
            w = copies if weights == "counts" else np.ones_like(copies)
            c = centre.centred(x).astype(float) / n
            total += (c * w[:, None]).T @ c
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dimensions)), pa.repeat(pa.scalar(part), dimensions),
             pa.array(list(total), pa.list_(pa.float64()))], names=["at", "part", "products"])

    def added(rows):
        rows = rows.sort_values("part")
        return pd.DataFrame({"at": rows["at"].iloc[:1], "products": [np.sum(np.stack(rows["products"]), axis=0)]})

    # a group is one row of the matrix: one list of ``dimensions`` numbers per task
    found = (vectors.mapInArrow(products, "at long, part long, products array<double>").groupBy("at")
             .applyInPandas(added, "at long, products array<double>").orderBy("at").collect())
    covariance = np.array([r["products"] for r in found]) / n
    values, directions = np.linalg.eigh((covariance + covariance.T) / 2)
    values, directions = values[::-1][:components], directions[:, ::-1][:, :components]
    signs = np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(directions.shape[1])])
    return Fit(n, sums, np.maximum(values, 0), directions * signs, float(np.trace(covariance)))


def identity_error(whitened, fit, weights):
    """The largest absolute entry of the whitened covariance minus the identity, over the
    components with variance; ``None`` without any."""
    live = np.flatnonzero(fit.live()).tolist()
    if not live:
        return None
    w = F.col("copies") if weights == "counts" else F.lit(1)
    value = {i: F.get("whitened", F.lit(i)) for i in live}
    means = whitened.agg(*[(F.sum(w * value[i]) / fit.n).alias(f"m{i}") for i in live]).first()
    pairs = [(i, j) for i in live for j in live if i <= j]
    found = whitened.agg(*[(F.sum(w * (value[i] - means[f"m{i}"]) * (value[j] - means[f"m{j}"])) / fit.n)
                           .alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(table, vec_id="vec_id", vector="embedding", components=COMPONENTS, weights="counts"):
    """One row per sound row of ``table``: id, n, deviation, whitened, explained, identity_error.

    Rows are dropped whose vector is null, empty, holds a null or an entry that is not finite
    (or of 2**43 and more), or has another length than most vectors (ties: the longest).
    ``weights`` says how a distinct vector counts in the fit: ``counts``, as often as rows hold
    it, or ``one``. n is the sum of the weights, ``deviation`` the exact sum of (n * x - S)^2, null
    beyond 63 bits. ``whitened`` and ``explained`` are lists over the components, at most the
    dimensions; where a component has no variance ``whitened`` is null. Ids may repeat or be
    null. Without sound rows nothing is returned.
    """
    if weights not in ("counts", "one"):
        raise ValueError("weights: counts or one")
    spark = table.sparkSession
    rows = whole(table, vec_id, vector).withColumns(
        {"k1": F.xxhash64(F.lit(1), "x"), "k2": F.xxhash64(F.lit(2), "x")})
    rows = stored(rows, "vectors")
    schema = (StructType([rows.schema["id"]]).add("n", "long").add("deviation", "long")
              .add("whitened", ArrayType(DoubleType())).add("explained", ArrayType(DoubleType())).add("identity_error", "double"))
    sizes = rows.where(F.size("x") > 0).groupBy(F.size("x").alias("size")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    if most is None:
        return spark.createDataFrame([], schema)
    dimensions, held = most["size"], most["count"]
    if dimensions > MAX_DIMENSIONS:
        raise ValueError(f"vectors of more than {MAX_DIMENSIONS} dimensions")
    rows = rows.where(F.size("x") == dimensions)
    distinct = stored(rows.groupBy("x", "k1", "k2").agg(F.count("*").alias("copies")), "distinct-vectors")
    fit = fitted(distinct, dimensions, components, weights)

    def each(batches):
        for batch, x, _ in blocks(batches, dimensions):
            lists = [[None if math.isnan(v) else v for v in own] for own in fit.whitened(x).tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("k1"), batch.column("k2"), batch.column("copies"),
                 pa.array(fit.deviation(x), pa.int64()), pa.array(lists, pa.list_(pa.float64()))],
                names=["k1", "k2", "copies", "deviation", "whitened"])

    done = stored(distinct.mapInArrow(each, "k1 long, k2 long, copies long, deviation long, whitened array<double>"),
                  "whitened")
    error = identity_error(done, fit, weights)
    hot = F.col("copies") * HOT > held
    narrow, often = rows.select("id", "k1", "k2"), F.broadcast(done.where(hot))  # fewer than HOT rows
    joined = narrow.join(often, ["k1", "k2"]).unionByName(
        narrow.join(often.select("k1", "k2"), ["k1", "k2"], "left_anti").join(done.where(~hot), ["k1", "k2"]))
    explained = F.array(*[F.lit(v).cast("double") for v in fit.explained()])
    return joined.select("id", F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened",
                         explained.alias("explained"), F.lit(error).cast("double").alias("identity_error"))
