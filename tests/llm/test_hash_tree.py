"""The hash tree: brute force, shares, growth, movement and slots."""

import hashlib
import math
import zlib
from collections import Counter

import pytest
from compare import connect
from demandlens.llm import catalog, hash_tree
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def leaf(tree, key):
    """The path of a key, in plain Python."""
    path, node = "", tree
    while isinstance(node, dict):
        scores = []
        for name, child in node.items():
            w = hash_tree.weight(child)
            if w > 0:
                x = int(hashlib.md5(f"{key}|{path}/{name}".encode()).hexdigest()[:12], 16)
                scores.append((math.log((x + 0.5) / 2 ** 48) / w, f"{path}/{name}", child))
        _, path, node = max(scores, key=lambda s: s[:2])
    return path


def paths(spark, tree, n=4000):
    rows = hash_tree.placed(spark.range(n).withColumnRenamed("id", "doc_id"), tree)
    return {r.doc_id: f"/{r.region}/{r.rack}/{r.shard}" for r in rows.collect()}


def test_query(spark):
    docs = dict(connect(SF).execute("SELECT doc_id, text FROM documents").fetchall())
    got = catalog.QUERIES["op12_sharding"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    now, grown = hash_tree.production_tree(8), hash_tree.production_tree(9)
    for r in got:
        data = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert str(r.shard) == leaf(now, r.doc_id).rsplit("/", 1)[1]
        assert str(r.grown_shard) == leaf(grown, r.doc_id).rsplit("/", 1)[1]
        assert r.grown_shard in (r.shard, 8)
    for shard in range(8):
        own = sorted((r.slot, r.doc_id) for r in got if r.shard == shard)
        assert [s for s, _ in own] == list(range(len(own))) and sorted(own, key=lambda x: x[1]) == own


def test_shares_follow_weights(spark):
    tree = {"a": {"r": {"0": 1.0, "1": 3.0}}, "b": {"r": {"2": 2.0}, "s": {"3": 2.0, "4": 0.0}}}
    n = Counter(p.rsplit("/", 1)[1] for p in paths(spark, tree, 20000).values())
    for shard, w in (("0", 1), ("1", 3), ("2", 2), ("3", 2)):
        assert n[shard] / 20000 == pytest.approx(w / 8, abs=0.02)
    assert n["4"] == 0


def test_growth_moves_into_the_new_shard_only(spark):
    before, after = paths(spark, hash_tree.production_tree(8)), paths(spark, hash_tree.production_tree(9))
    moved = [k for k in before if before[k] != after[k]]
    assert all(after[k] == "/own8/own8/8" for k in moved)
    assert len(moved) / len(before) == pytest.approx(1 / 9, abs=0.02)


@pytest.mark.parametrize("now", [0.0, 0.5, 4.0])
def test_movement_stays_in_changed_subtrees(spark, now):
    tree = hash_tree.production_tree(8)
    before = paths(spark, tree)
    tree["0"]["1"]["3"] = now
    after = paths(spark, tree)
    changed = ["/0", "/0/1", "/0/1/3"]  # the subtrees whose weight is another one now
    moved = [k for k in before if before[k] != after[k]]
    assert moved
    for k in moved:
        old, new = before[k].split("/"), after[k].split("/")
        depth = next(i for i in range(len(old)) if old[i] != new[i])
        to, out = "/".join(new[:depth + 1]), "/".join(old[:depth + 1])
        assert (to if now > 1 else out) in changed


def test_edges(spark):
    rows = spark.createDataFrame([(None, None, "x"), (None, "", "y"), (7, "abc", "z"), (7, "abc", None)],
                                 "doc_id long, text string, shard string")
    tree = hash_tree.production_tree(8)
    named = hash_tree.placed(rows, tree)
    assert named.columns == ["doc_id", "text", "shard", "region", "rack", "_shard"]
    got = hash_tree.assigned(rows, tree, hash_tree.production_tree(9)).collect()
    nulls, sevens = [r for r in got if r.doc is None], [r for r in got if r.doc == 7]
    assert {(r.size, r.text_crc32) for r in nulls} == {(1, 0)} and len({r.shard for r in nulls}) == 1
    assert len({r.shard for r in sevens}) == 1 and len({(r.shard, r.slot) for r in got}) == 4
    assert hash_tree.assigned(rows.limit(0), tree, tree).collect() == []
    for bad in ({}, {"a": {"b": {"0": 0.0}}}, {"a": {"b": {"0": 2.0, "1": -1.0}}}):
        with pytest.raises(ValueError):
            hash_tree.placed(rows, bad)
    with pytest.raises(ValueError):
        hash_tree.production_tree(7)


def test_one_hot_id_is_cut_over_ranges(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("doc"),
                                    F.lit(1).alias("shard"))
    got = hash_tree.numbered(rows, "shard", ["doc"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    found = got.orderBy("slot").collect()
    assert [r.slot for r in found] == list(range(3000))
    assert [r.doc for r in found] == sorted(r.doc for r in found)


def test_write_shards(spark, tmp_path):
    docs = spark.range(100).withColumnRenamed("id", "doc_id").withColumn("text", F.lit("t"))
    hash_tree.write_shards(docs, hash_tree.production_tree(8), f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert {r.doc_id: f"/{r.region}/{r.rack}/{r.shard}" for r in back.collect()} == paths(spark, hash_tree.production_tree(8), 100)
