"""Second-order boosted trees for a 0/1 outcome, on histograms.

Every feature is cut once at quantiles of all training rows, and rows become blocks of bin
numbers that stay where they are. A level of a tree is one aggregate: each task adds up
gradient and curvature per (node, feature, bin) of its blocks, Spark sums these, and
the driver, which sees nodes x features x bins sums, picks the splits with the
largest gain. These are hundreds of small jobs over the same rows, so they run on the blocks'
RDD: planning a DataFrame for each took longer than its work. Gradients are rounded to a
fixed number of binary places before they are added, so the sums do not depend on their
order and a model is the same in every run.

The margin of a block is that of the last refresh plus the trees grown since; every
``REFRESH`` trees the blocks are checkpointed with their margins.
"""

import json
import math

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import functions as F

from ..session import durable

BINS = 256
QUANTILE_ACCURACY = 20_000
REFRESH = 20
#: Binary places of a gradient; sums of 2**33 rows fit into 64 bits.
PLACES = 30
#: Rows of a block.
BLOCK_ROWS = 1 << 16


def cut_points(df, features, bins=BINS):
    """Per feature the ascending values that end its bins: quantiles of all rows, at most
    ``bins - 1`` of them. A row is in the bin of the first cut that is not below it."""
    shares = [i / bins for i in range(1, bins)]
    found = df.agg(*[F.percentile_approx(F.col(f).cast("double"), shares, QUANTILE_ACCURACY).alias(f)
                     for f in features], *[F.max(F.col(f).cast("double")).alias(f"max_{f}") for f in features]).first()
    cuts = [np.unique(np.array(found[f] or [], float)) for f in features]
    # nothing lies beyond the largest value, so a cut there would split off nothing
    return [c[c < found[f"max_{f}"]] for c, f in zip(cuts, features)]


def blocked(df, features, label, cuts):
    """Rows as blocks: n, codes (a plane of bin numbers per feature), label and margin."""
    def each(batches):
        waiting, held = [], 0

        def flush():
            table = pa.Table.from_batches(waiting)
            codes = [np.searchsorted(c, table.column(f).to_numpy(), "left").astype(np.uint8)
                     for c, f in zip(cuts, features)]
            y = table.column(label).to_numpy().astype(np.uint8)
            return pa.RecordBatch.from_arrays(
                [pa.array([len(y)], pa.int64()), pa.array([np.concatenate(codes).tobytes()], pa.binary()),
                 pa.array([y.tobytes()], pa.binary()), pa.array([np.zeros(len(y)).tobytes()], pa.binary())],
                names=["n", "codes", "label", "margin"])

        for batch in batches:
            waiting.append(batch)
            held += batch.num_rows
            if held >= BLOCK_ROWS:
                yield flush()
                waiting, held = [], 0
        if held:
            yield flush()

    rows = df.select(*[F.col(f).cast("double").alias(f) for f in features], F.col(label).cast("int").alias(label))
    return rows.mapInArrow(each, "n long, codes binary, label binary, margin binary")


class Tree:
    """A full binary tree as a heap: node i has children 2i + 1 and 2i + 2. ``feature`` is -1
    where a node is not split; rows with a bin up to ``bin`` go left. ``value`` counts at the
    node where a row ends."""

    def __init__(self, depth):
        size = (2 << depth) - 1
        self.depth = depth
        self.feature, self.bin = np.full(size, -1), np.zeros(size, int)
        self.value, self.gain = np.zeros(size), np.zeros(size)

    def place(self, codes, levels):
        """The node of each row after ``levels`` levels; rows stay at a node without a split."""
        at = np.zeros(codes.shape[1], np.int64)
        rows = np.arange(codes.shape[1])
        for _ in range(levels):
            feature = self.feature[at]
            child = 2 * at + 1 + (codes[feature, rows] > self.bin[at])
            at = np.where(feature >= 0, child, at)
        return at


def opened(rows, features):
    """Codes, labels and margins of block rows."""
    for n, codes, label, margin in rows:
        yield (np.frombuffer(codes, np.uint8).reshape(features, n), np.frombuffer(label, np.uint8),
               np.frombuffer(margin))


def grown_margin(codes, margin, trees):
    for tree in trees:
        margin = margin + tree.value[tree.place(codes, tree.depth)]
    return margin


def fixed(values):
    """Rounded to ``PLACES`` binary places, as whole numbers."""
    return np.rint(values * float(1 << PLACES))


def level_sums(rows, features, base, trees, tree, level):
    """Gradient and curvature per node, feature and bin over the rows at a level's nodes.

    Tasks add up their blocks, and a tree of further tasks their sums; the driver gets a few
    of the size of the result."""
    first, nodes = (1 << level) - 1, 1 << level

    def each(part):
        total = np.zeros((2, nodes, features, BINS), np.int64)
        for codes, y, margin in opened(part, features):
            p = 1 / (1 + np.exp(-base - grown_margin(codes, margin, trees)))
            at = tree.place(codes, level) - first
            here = np.flatnonzero(at >= 0)  # the others ended higher up
            g, h, at = fixed(p - y)[here], fixed(p * (1 - p))[here], at[here]
            for f in range(features):
                slot = at * BINS + codes[f][here]
                for k, weights in enumerate((g, h)):
                    total[k, :, f, :] += np.bincount(slot, weights, nodes * BINS).astype(np.int64).reshape(nodes, BINS)
        yield total

    return rows.mapPartitions(each).treeReduce(np.add) / float(1 << PLACES)


def kept(blocks):
    """The rows of checkpointed blocks in memory, for the many small jobs of the rounds."""
    return blocks.rdd.persist(StorageLevel.MEMORY_AND_DISK)


def split_level(tree, level, sums, bins, penalty, least_weight, rate):
    """Split the nodes of a level where that gains, and set the values of their children.

    ``sums`` are (g, h) per node, feature and bin, ``bins`` the number of bins per feature. The
    first of equal gains wins."""
    first = (1 << level) - 1
    for node in range(1 << level):
        i = first + node
        if level and tree.feature[(i - 1) // 2] < 0:
            continue
        g, h = sums[:, node]
        whole_g, whole_h = g[0].sum(), h[0].sum()
        left_g, left_h = np.cumsum(g, axis=1), np.cumsum(h, axis=1)
        right_g, right_h = whole_g - left_g, whole_h - left_h
        gain = left_g ** 2 / (left_h + penalty) + right_g ** 2 / (right_h + penalty) - whole_g ** 2 / (whole_h + penalty)
        allowed = (left_h >= least_weight) & (right_h >= least_weight)
        for f, count in enumerate(bins):
            allowed[f, max(count - 1, 0):] = False  # nothing to the right of the last bin
        gain = np.where(allowed, gain, -np.inf)
        f, k = np.unravel_index(np.argmax(gain), gain.shape)
        if gain[f, k] <= 1e-6:
            continue
        tree.feature[i], tree.bin[i], tree.gain[i] = f, k, gain[f, k]
        tree.value[2 * i + 1] = -rate * left_g[f, k] / (left_h[f, k] + penalty)
        tree.value[2 * i + 2] = -rate * right_g[f, k] / (right_h[f, k] + penalty)


def fit_boosted(df, features, label="placed", rounds=200, depth=3, rate=0.1, penalty=1.0, least_weight=1.0,
                tasks=None):
    """A ``BoostedTreesModel`` from all rows of ``df``, none of whose features or labels is null.

    Newton boosting of the log loss: a leaf is -g / (h + ``penalty``) times ``rate``, a split needs
    ``least_weight`` of curvature on both sides and a gain above zero. It starts from the share of
    ones. ``tasks`` is the largest number of tasks that the blocks are kept in.
    """
    features = list(features)
    cuts = cut_points(df, features)
    share = df.agg(F.avg(F.col(label).cast("double"))).first()[0]
    if share is None or not 0 < share < 1:
        raise ValueError("training needs rows of both outcomes")
    base = math.log(share / (1 - share))
    blocks = blocked(df if tasks is None else df.coalesce(tasks), features, label, cuts)
    blocks, fresh, trees = durable(blocks), [], []
    schema, rows = blocks.schema, kept(blocks)
    for number in range(rounds):
        tree = Tree(depth)
        for level in range(depth):
            sums = level_sums(rows, len(features), base, fresh, tree, level)
            split_level(tree, level, sums, [len(c) + 1 for c in cuts], penalty, least_weight, rate)
            if not (tree.feature[(1 << level) - 1:(2 << level) - 1] >= 0).any():
                break
        trees.append(tree)
        if tree.feature[0] < 0:
            break  # no later tree finds a split either
        fresh.append(tree)
        if len(fresh) == REFRESH and number + 1 < rounds:
            def renewed(batches, fresh=tuple(fresh)):
                for batch in batches:
                    own = zip(*(c.to_pylist() for c in batch.columns))
                    margins = [grown_margin(c, m, fresh).tobytes() for c, _, m in opened(own, len(features))]
                    yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(margins, pa.binary())],
                                                     names=schema.names)

            blocks, fresh = durable(blocks.mapInArrow(renewed, schema)), []
            rows.unpersist()
            rows = kept(blocks)
    rows.unpersist()
    return BoostedTreesModel(inputCols=features, base=base, trees=stored_trees(trees, cuts))


def stored_trees(trees, cuts):
    """Per tree (features, thresholds, values, gains) of its heap, as JSON. A node without a
    split sends all rows left, and its value stands in all leaves below it."""
    out = []
    for tree in trees:
        if tree.feature[0] < 0:
            continue
        value, feature = tree.value.copy(), tree.feature.tolist()
        inner = len(feature) // 2
        for i in range(1, len(feature)):
            if feature[(i - 1) // 2] < 0:
                value[i] = value[(i - 1) // 2]
        thresholds = [float(cuts[f][k]) if f >= 0 else None for f, k in zip(feature[:inner], tree.bin)]
        out.append({"feature": [max(f, 0) for f in feature[:inner]], "threshold": thresholds,
                    "value": value[inner:].tolist(), "gain": tree.gain[:inner].tolist()})
    return json.dumps(out)


class BoostedTreesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted trees. ``transform`` adds ``probability`` of outcome 1 as a column expression; it is
    null where a feature is null."""

    inputCols = Param(Params._dummy(), "inputCols", "feature columns", TypeConverters.toListString)
    base = Param(Params._dummy(), "base", "log odds before the first tree", TypeConverters.toFloat)
    trees = Param(Params._dummy(), "trees", "trees as JSON", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "probability column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, base=0.0, trees="[]", outputCol="probability"):
        super().__init__()
        self._setDefault(base=0.0, trees="[]", outputCol="probability")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def grown(self):
        return json.loads(self.getOrDefault(self.trees))

    def importances(self):
        """Mean gain of a feature's splits, as a share of the sum over the features."""
        names = self.getOrDefault(self.inputCols)
        gain, splits = np.zeros(len(names)), np.zeros(len(names))
        for tree in self.grown():
            for f, t, g in zip(tree["feature"], tree["threshold"], tree["gain"]):
                if t is not None:
                    gain[f] += g
                    splits[f] += 1
        mean = gain / np.maximum(splits, 1)
        return (mean / max(mean.sum(), 1e-300)).tolist()

    def margin(self):
        """Log odds as an expression: the values of all trees are looked up in one pass over
        a list of trees, so the plan has the same size for any number of them."""
        names = [F.col(c).cast("double") for c in self.getOrDefault(self.inputCols)]
        base, grown = F.lit(self.getOrDefault(self.base)), self.grown()
        anything = sum((c * 0.0 for c in names), F.lit(0.0))  # null where a feature is null
        if not grown:
            return base + anything
        depth = int(math.log2(len(grown[0]["value"])))
        trees = F.from_json(F.lit(json.dumps([{k: t[k] for k in ("feature", "threshold", "value")} for t in grown])),
                            "array<struct<feature:array<int>,threshold:array<double>,value:array<double>>>")

        def leaf(tree, x):
            at = F.lit(0)
            for _ in range(depth):
                # a missing threshold sends the row left
                right = F.coalesce(F.get(x, F.get(tree["feature"], at)) > F.get(tree["threshold"], at), F.lit(False))
                at = at * 2 + 1 + right.cast("int")
            return F.get(tree["value"], at - (len(grown[0]["value"]) - 1))

        summed = F.get(F.transform(F.array(F.array(*names)), lambda x: F.aggregate(
            trees, base, lambda total, tree: total + leaf(tree, x))), 0)
        return summed + anything

    def _transform(self, df):
        return df.withColumn(self.getOrDefault(self.outputCol), 1.0 / (1.0 + F.exp(-self.margin())))
