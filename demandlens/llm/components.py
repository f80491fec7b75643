"""Connected components of an edge table, by large-star and small-star rounds."""

import pyarrow as pa
from demandlens.llm.frames import stored
from pyspark.sql import Observation
from pyspark.sql import functions as F

#: Up to so many edges one task joins the trees of all nodes; beyond, rounds by key.
ONE_TASK = 200_000


def observed(edges, arrow_rows=None):
    """``edges`` written to the shared folder, with their number and a digest from the same job."""
    seen = Observation()
    edges = edges.observe(seen, F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("mark"))
    table = stored(edges, "edges", arrow_rows)
    return table, seen.get.get("n") or 0, seen.get.get("mark")


def star(edges, larger_only):
    """Join every node's neighbours to the smallest node among them and itself.

    ``edges`` has (u, v). With ``larger_only`` the neighbours above the node move
    (large star), else those below it and the node itself (small star).
    """
    if larger_only:
        near = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = near.join(least, "u")
    if larger_only:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    below = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return below.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def joined_trees(edges):
    """(node, root) of a small edge table: one task joins trees under their smaller root."""
    schema = edges.select(F.col("u").alias("node"), F.col("v").alias("root")).schema

    def each(batches):
        above = {}

        def root(x):
            path = []
            while above.setdefault(x, x) != x:
                path.append(x)
                x = above[x]
            for p in path:
                above[p] = x
            return x

        kind = pa.null()
        for batch in batches:
            kind = batch.schema.field("u").type
            for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
                u, v = root(u), root(v)
                if u != v:
                    above[max(u, v)] = min(u, v)
        nodes = list(above)
        if nodes:
            yield pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array([root(x) for x in nodes], kind)],
                                             names=["node", "root"])

    return edges.select("u", "v").coalesce(1).mapInArrow(each, schema)


def components(edges, arrow_rows=None):
    """(node, root) for every node of ``edges`` (u, v); the root is the smallest node.

    Self loops and repeated edges do no harm. Up to ``ONE_TASK`` different edges one task joins
    them. ``arrow_rows`` is for ``edges`` that Python tasks make of wide rows. Beyond that, a node's neighbours are only combined by ``min`` and joined to one row,
    so a hub with very many neighbours can be split; each round is one job, written to the
    shared folder, and a chain of n nodes takes about log n rounds.
    """
    now, n, mark = observed(edges.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                                         F.least("u", "v").alias("v")).distinct(), arrow_rows)
    while n > ONE_TASK:
        now, n, after = observed(star(star(now, True), False))
        if (n, after) == mark:
            nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return nodes.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = n, after
    return joined_trees(now)
