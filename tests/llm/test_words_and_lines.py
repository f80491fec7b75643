"""Words as byte positions, and line dedup against a plain version."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from demandlens.llm import line_runs
from demandlens.llm.frames import fresh, steps
from demandlens.llm.words import ALPHANUMERIC, NOT_BLANK, Words
from pyspark.sql import functions as F

TEXTS = ["", None, " A\tbC\n", "éÀ x", "a" * 9000 + " b", "x\x00y z", "日本 語", "\x0b\x0c", "end", "the THE the"]


@pytest.mark.parametrize("inside, pattern", [(NOT_BLANK, r"[^\x20\x09-\x0D]+"),
                                             (ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
def test_words_equal_the_pattern(inside, pattern):
    words = Words(pa.array(TEXTS, pa.string()), inside)
    lower = {ord(a): ord(a.lower()) for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    want = [re.findall(pattern, (t or "").translate(lower)) for t in TEXTS]
    got = [[words.text(i).decode() for i in range(a, b)] for a, b in zip(words.first[:-1], words.first[1:])]
    assert got == want
    flat = [w for doc in want for w in doc]
    hashes = words.hashes()
    assert len(set(hashes.tolist())) == len(set(flat))
    assert all((hashes[i] == hashes[j]) == (flat[i] == flat[j]) for i in range(len(flat)) for j in range(len(flat)))


def test_words_of_a_slice():
    whole = pa.array(TEXTS, pa.string())
    assert np.array_equal(Words(whole.slice(2, 3)).counts(), Words(whole).counts()[2:5])


@pytest.mark.parametrize("texts", [TEXTS, [t or "Q w" for t in TEXTS]])
def test_words_of_every_slice(texts):
    whole = pa.array(texts, pa.string())
    for begin in range(len(texts)):
        for size in range(len(texts) - begin + 1):
            words, every = Words(whole.slice(begin, size)), Words(whole)
            a, b = every.first[begin], every.first[begin + size]
            assert [words.text(i) for i in range(len(words))] == [every.text(i) for i in range(a, b)]
            assert np.array_equal(words.hashes(), every.hashes()[a:b])
            assert np.array_equal(words.owners(), every.owners()[a:b] - begin)


def test_steps_keep_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(TEXTS, pa.string())], names=["text"])
    parts = list(steps([batch], "text", 10))
    assert pa.Table.from_batches(parts).column("text").to_pylist() == TEXTS
    assert len(parts) > 3


def test_fresh_names():
    assert fresh(["a", "B", "_b"], "b") == "__b"


def brute(rows, min_points=20, min_docs=3):
    def key(line):
        return re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate(
            {ord(a): ord(a.lower()) for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})

    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_points:
                holders.setdefault(key(line), set()).add(-1 if i is None else i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == i]
        out.append((i, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


SHARED = "This line is in MANY documents, éà"
ROWS = [(1, f"own one\n{SHARED}\nmore"), (2, f"  {SHARED.replace('MANY', 'many')}\t\nother"), (3, f"{SHARED}\n{SHARED}\nx"),
        (4, "short\nshort"), (5, "short"), (6, "short"), (7, None), (8, ""), (9, "\n\n"), (2, "a repeated id"),
        (10, "twenty code points é\nb"), (11, "twenty code points é"), (12, "twenty code points é\n" * 3),
        (None, SHARED), (13, "in two documents only, no more"), (14, "in two documents only, no more"),
        (13, "in two documents only, no more")]


@pytest.mark.parametrize("batches, fanout", [(1, 4), (3, 2), (5, 2)])
def test_line_dedup_equals_brute_force(spark, batches, fanout):
    docs = spark.createDataFrame(ROWS, "doc_id int, text string")
    got = line_runs.dedup_lines(docs, batches=batches, fanout=fanout).collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute(ROWS)


def test_line_dedup_keeps_clashing_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "x", 5, "d", "k")], "doc_id int, text string, n_lines int, drops string, key string")
    row = line_runs.dedup_lines(docs).first()
    assert row.asDict() == {"doc_id": 1, "text": "x", "n_lines": 5, "drops": "d", "key": "k", "_n_lines": 1, "n_dropped": 0}
    assert line_runs.dedup_lines(docs.limit(0)).count() == 0


def test_a_new_batch_meets_the_runs(spark):
    runs = line_runs.LineRuns(spark, fanout=2)
    first = spark.createDataFrame([(1, b"a"), (2, b"a"), (2, b"b")], "doc int, key binary")
    second = spark.createDataFrame([(3, b"a"), (3, b"c")], "doc int, key binary")
    assert runs.new_keys(first).count() == 3
    runs.add(first)
    assert [bytes(r.key) for r in runs.new_keys(second).collect()] == [b"c"]
    runs.add(second)
    assert len(runs.runs()) == 1 and len(runs.levels[1]) == 1
    assert {(bytes(r.key), r.docs, r["last"]) for r in runs.compacted().collect()} == {(b"a", 3, 3), (b"b", 1, 2), (b"c", 1, 3)}


def test_dedup_meets_live_runs_and_compacts(spark, monkeypatch):
    met, levels = [], []
    plain_keys, plain_write = line_runs.LineRuns.new_keys, line_runs.LineRuns._write
    monkeypatch.setattr(line_runs.LineRuns, "new_keys", lambda self, rows: met.append(len(self.runs())) or plain_keys(self, rows))
    monkeypatch.setattr(line_runs.LineRuns, "_write", lambda self, run, level: levels.append(level) or plain_write(self, run, level))
    docs = spark.createDataFrame(ROWS, "doc_id int, text string")
    got = line_runs.dedup_lines(docs).collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute(ROWS)
    assert met == [0, 1, 1] and levels == [0, 0, 1, 0]


def test_hot_line(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("the very same long line everywhere\nx").alias("text"))
    out = line_runs.dedup_lines(docs)
    assert out.agg(F.sum("n_dropped")).first()[0] == 299
    kept = out.where("n_dropped = 0").first()
    assert kept.doc_id == 299 and hashlib.sha256(kept.text.encode()).digest()
