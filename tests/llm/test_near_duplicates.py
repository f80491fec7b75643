"""HyperMinHash near duplicates and components against brute force."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from demandlens.llm import components as cc
from demandlens.llm import hyperminhash as H
from demandlens.llm.words import Words
from pyspark.sql import functions as F


def sets_of(texts, size):
    out = []
    for text in texts:
        words = (text or "").lower().split()
        out.append(frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
                   if len(words) >= size else frozenset([tuple(words)] if words else []))
    return out


def brute(rows, size, percent):
    sets = sets_of([t for _, t in rows], size)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        both, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if both and 100 * both >= percent * union:
            parent[find(a)] = find(b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            root = find(i)
            least[root] = min(least.get(root, doc), doc)
    return sorted([(doc, len(sets[i]), least.get(find(i)), doc == least.get(find(i))) for i, (doc, _) in enumerate(rows)],
                  key=repr)


def corpus(seed, groups=12, copies=6):
    draw = random.Random(seed)
    rows, doc = [], 0
    for _ in range(groups):
        words = [f"w{draw.randrange(400)}" for _ in range(draw.choice([3, 5, 12, 60, 200]))]
        for _ in range(copies):
            own = list(words)
            for _ in range(draw.choice([0, 0, 1, 2, 4])):
                own[draw.randrange(len(own))] = f"e{draw.randrange(9999)}"
            rows.append((doc, " ".join(own)))
            doc += 1
    return rows


@pytest.mark.parametrize("size", [4, 5])
def test_components_equal_brute_force(spark, size):
    rows = corpus(size) + [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (None, "one"),
                           (5, "a repeated id with other words in it"), (905, "W1 " * 5000)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    got = sorted([tuple(r) for r in H.near_duplicates(docs, size).collect()], key=repr)
    assert got == brute(rows, size, 80)


def test_large_bucket_in_blocks(spark, monkeypatch):
    """A chain of copies: each is like its neighbours only, all in large buckets."""
    monkeypatch.setattr(H, "SMALL", 2)
    monkeypatch.setattr(H, "HELD", 3)
    monkeypatch.setattr(H, "STREAMED", 5)
    base = [f"b{i}" for i in range(120)]
    rows = [(i, " ".join(f"n{k}" if k < 3 * i else w for k, w in enumerate(base))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    assert sorted([tuple(r) for r in H.near_duplicates(docs, 4).collect()], key=repr) == brute(rows, 4, 80)


def test_deduplicate_keeps_the_columns(spark):
    docs = spark.createDataFrame([(2, "a b c d e f", 1, "x"), (1, "a b c d e f", 2, "y"), (3, None, 3, "z")],
                                 "doc_id int, text string, n int, component string")
    out = H.deduplicate(docs)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [1, 3]
    assert H.deduplicate(docs.limit(0)).count() == 0


def test_registers_estimate_similarity():
    draw = np.random.default_rng(1)
    for share in (0.5, 0.8, 0.95):
        both = draw.integers(0, 1 << 63, 4000, dtype=np.uint64)
        extra = int(4000 * (1 - share) / (2 * share))
        a, b = (np.unique(np.concatenate([both, draw.integers(0, 1 << 63, extra, dtype=np.uint64)]) * np.uint64(2))
                for _ in range(2))
        regs = H.registers([a, b])
        near, used = H.estimate(regs[:1], np.array([len(a)]), regs[1:], np.array([len(b)]))
        assert abs(near[0] - share) < 0.13 and used[0] == H.BUCKETS
    assert (H.registers([a[:0]]) == 0).all()


def test_short_and_empty_sets():
    words = Words(pa.array(["a b c d", "a b", "", "A B"]))
    a, b, c, d = H.shingle_sets(words, 4)
    assert len(a) == len(b) == 1 and len(c) == 0 and b[0] == d[0] != a[0]


@pytest.mark.parametrize("one_task", [0, 10 ** 6])
def test_connected_components(spark, monkeypatch, one_task):
    monkeypatch.setattr(cc, "ONE_TASK", one_task)
    draw = random.Random(3)
    pairs = [(draw.randrange(200), draw.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(7, 7)]
    root = {n: n for p in pairs for n in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in cc.components(spark.createDataFrame(pairs, "u int, v int")).collect()}
    assert got == {n: find(n) for n in root if n in got} and set(root) - set(got) <= {7} | {a for a, b in pairs if a == b}


def test_components_of_nothing(spark):
    assert cc.components(spark.createDataFrame([], "u int, v int")).count() == 0


def test_exact_copies_are_one_class(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("the same six words in all").alias("text"))
    out = H.near_duplicates(docs, 4)
    assert out.where("kept").count() == 1 and out.agg(F.max("component")).first()[0] == 0
