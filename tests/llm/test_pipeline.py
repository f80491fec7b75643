"""The corpus pipeline and the queries of this package against their SQL."""

import re
from itertools import combinations
from pathlib import Path

import corpus_pipeline
import pytest
import sentencepiece
from compare import connect, difference
from demandlens.llm import catalog, pieces

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(catalog.ORACLE))
def test_query_equals_sql(spark, con, name):
    assert difference(catalog.QUERIES[name](spark, SF), con, catalog.ORACLE[name]) is None


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.createDataFrame([
        (1, "the words of the first one are these and no others", "en", "s", 5),
        (2, "the words of the first one are these and no others", "en", "s", 5),
        (3, None, "en", "s", None), (4, "12 34", None, "s", 2), (5, "", "fr", None, 0)],
        "doc_id long, text string, lang string, source string, n_chars long")
    left = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, left[-1], SF)
        if name != "sentencepiece":
            assert out.columns == docs.columns
        left.append(out)
    assert sorted(r.doc_id for r in left[1].collect()) == [1, 2]
    assert [r.doc_id for r in left[3].collect()] == [1]
    last = left[-1].collect()
    assert [r.doc_id for r in last] == [1] and last[0].parity and last[0].round_trip


def test_run_equals_its_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, docs.collect()))
    assert 0 < got.count() < spark.read.parquet(f"{SF}/documents.parquet").count()


def plain_stages(docs, benchmark):
    """Stages 2 to 4 over id -> text, in plain Python."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def key(line):
        return line.strip("\x20\x09\x0a\x0b\x0c\x0d").translate(lower)

    holders = {}
    for i, text in docs.items():
        for line in text.split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(i)
    many = {k: max(ids) for k, ids in holders.items() if len(ids) >= 3}
    docs = {i: "\n".join(x for x in t.split("\n") if many.get(key(x), i) == i) for i, t in docs.items()}

    sets = {}
    for i, text in docs.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", text.translate(lower))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(docs), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    docs = {i: t for i, t in docs.items() if find(i) == i}

    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(lower))

    windows = set()
    for text in benchmark:
        w = words(text)
        windows |= {tuple(w[k:k + 10]) for k in range(max(len(w) - 9, 1))} if w else set()
    sizes = {len(x) for x in windows}

    def hit(text):
        w = words(text)
        return any(tuple(w[k:k + n]) in windows for n in sizes for k in range(len(w) - n + 1))

    return {i: t for i, t in docs.items() if not hit(t)}


def test_run_equals_plain_stages(spark, con):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = {r.doc_id: r.text for r in corpus_pipeline.language_id(spark, docs, SF).collect()}
    left = plain_stages(first, [t for t, in con.execute("SELECT text FROM benchmark").fetchall()])
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == set(left) and 0 < len(left) < len(first)
    for i, text in left.items():
        assert list(got[i].ids) == model.encode(text) and got[i].parity and got[i].round_trip
