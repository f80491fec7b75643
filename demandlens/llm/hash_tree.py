"""Sharding by a hierarchical weighted hash tree.

Shards hang below racks, racks below regions; the weight of a rack or region is the sum of
its shards. A key starts at the root and at each level draws one child: every child has a
hash of (key, child's path), turned into a uniform number u, and the child with the largest
ln(u) / weight wins, which happens with a probability in proportion to its weight. A draw
depends on the key, the child and its weight alone, so a changed weight moves keys only
into or out of the subtrees whose weight changed, on every level.

A shard that is added by ``production_tree`` opens a region of its own. No other subtree's weight
changes then, so keys move into the new shard only.

All of it is column expressions; rows are only shuffled, as ids and figures, to number
them inside their shard.
"""

from demandlens.functions.hashing import draw_long
from demandlens.llm.frames import fresh, stored
from pyspark.sql import Window
from pyspark.sql import functions as F

#: The production tree: shards a rack, racks a region, and shards that are laid out so.
RACK, REGION, BASE = 2, 2, 8
_SPAN = float(1 << 48)


def production_tree(shards, base=BASE):
    """{region: {rack: {shard: weight}}} for a number of shards: the first ``base`` fill racks
    and regions, each later one has a region and a rack of its own. All weights are 1."""
    if shards < base:
        raise ValueError(f"the tree starts with {base} shards")
    tree = {}
    for i in range(base):
        tree.setdefault(str(i // (RACK * REGION)), {}).setdefault(str(i // RACK), {})[str(i)] = 1.0
    for i in range(base, shards):
        tree[f"own{i}"] = {f"own{i}": {str(i): 1.0}}
    return tree


def weight(node):
    """The weight of a subtree, or of a shard."""
    return float(node) if not isinstance(node, dict) else sum(weight(x) for x in node.values())


def children(tree, depth):
    """path of each node ``depth`` levels below the root -> its (path, weight) children.

    Children without weight are left out: nothing is drawn into them."""
    level = {"": tree}
    for _ in range(depth):
        level = {f"{path}/{name}": node for path, own in level.items() for name, node in own.items()
                 if weight(node) > 0}
    return {path: [(f"{path}/{name}", weight(node)) for name, node in own.items() if weight(node) > 0]
            for path, own in level.items()}


def drawn(key, options):
    """The path that the text column ``key`` draws among (path, weight) ``options``: an array
    of structs, or a column of such."""
    def score(child):
        u = (draw_long(key, child["path"]).cast("double") + 0.5) / _SPAN
        return F.struct((F.log(u) / child["weight"]).alias("score"), child["path"].alias("path"))

    return F.array_max(F.transform(options, score))["path"]


def placed(docs, tree, key="doc_id", names=("region", "rack", "shard")):
    """``docs`` plus the path of the shard of each row, one text column a level.

    Only the key decides: rows with equal keys share a shard, a null key counts as empty
    text. ``names`` get leading underscores where ``docs`` has such columns. A tree whose
    weights are all zero, or that has a negative one, is refused. No rows in, no rows out.
    """
    def leaves(node):
        return [x for own in node.values() for x in leaves(own)] if isinstance(node, dict) else [node]

    if min(leaves(tree), default=0) < 0 or weight(tree) <= 0:
        raise ValueError("shards need weights of zero or more, and one of them above zero")
    out = []
    for name in names:
        out.append(fresh(docs.columns + out, name))
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    path, table = F.lit(""), docs
    for depth, name in enumerate(out):
        known = children(tree, depth)
        entries = [x for p, options in known.items() for x in (
            F.lit(p), F.array(*[F.struct(F.lit(c).alias("path"), F.lit(w).alias("weight")) for c, w in options]))]
        table = table.withColumn(name, drawn(text, F.element_at(F.create_map(*entries), path)))
        path = F.col(name)
    return table.withColumns({name: F.element_at(F.split(name, "/"), -1) for name in out})


def numbered(rows, shard, order, name="slot"):
    """``rows`` plus a number from 0 without gaps inside each value of ``shard``, by ``order``
    (nulls first); rows that ``order`` does not tell apart are numbered in any order.

    Rows are dealt by ranges of (shard, order, place), so a shard or a repeated key is cut
    over many tasks; numbers are the place in the range plus the sizes of the shard's
    earlier ranges. ``rows`` should come from a stored table.
    """
    block, at = (fresh([*rows.columns, name], n) for n in ("block", "at"))
    by = [shard, *order]
    ranged = (rows.withColumn(at, F.monotonically_increasing_id())
              .repartitionByRange(*by, at).sortWithinPartitions(*by, at)
              .withColumns({block: F.spark_partition_id(), at: F.monotonically_increasing_id()}))
    ranged = stored(ranged, "ranges")
    earlier = Window.partitionBy(shard).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    size, first, offset = (fresh([*ranged.columns, name], n) for n in ("size_", "first_", "offset_"))
    blocks = ranged.groupBy(shard, block).agg(F.count("*").alias(size), F.min(at).alias(first))  # a few rows a task
    blocks = blocks.select(shard, block, first, F.coalesce(F.sum(size).over(earlier), F.lit(0)).alias(offset))
    return (ranged.join(blocks, [shard, block])
            .withColumn(name, F.col(offset) + F.col(at) - F.col(first)).drop(block, at, first, offset))


def assigned(docs, tree, grown, doc_id="doc_id", text="text"):
    """One row per row of ``docs``: doc, size, text_crc32, shard, slot and grown_shard.

    ``size`` is the bytes of the text plus 1, ``slot`` the place in the shard by id, checksum
    and size, ``grown_shard`` the shard in the tree ``grown``. Null text has no bytes.
    Repeated rows get slots of their own.
    """
    bare = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc"), (F.octet_length(bare) + 1).cast("long").alias("size"),
                       F.crc32(bare.cast("binary")).alias("text_crc32"))
    rows = placed(rows, tree, "doc", ("region", "rack", "shard"))
    rows = placed(rows, grown, "doc", ("region_", "rack_", "grown_shard"))
    rows = rows.select("doc", "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
                       F.col("grown_shard").cast("int").alias("grown_shard"))
    return numbered(stored(rows, "shards"), "shard", ["doc", "text_crc32", "size"])


def write_shards(docs, tree, path, key="doc_id"):
    """Write ``docs`` as one folder per region, rack and shard; rows are not shuffled."""
    names = ("region", "rack", "shard")
    table = placed(docs, tree, key, names)
    own = table.columns[-len(names):]
    table.write.partitionBy(*own).parquet(path)
