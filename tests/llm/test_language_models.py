"""The hidden Markov model, Kneser-Ney and the piece encoder."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from demandlens.llm import hidden_markov as hmm
from demandlens.llm import kneser_ney as kn
from demandlens.llm import pieces
from pyspark.sql import functions as F

MODEL = pieces.MODEL


def small_model(states=3, classes=5, seed=1):
    draw = np.random.default_rng(seed)

    def rows(*shape):
        x = draw.random(shape)
        return x / x.sum(axis=-1, keepdims=True)

    return hmm.Model(rows(states), rows(states, states), rows(states, classes).T, None, None)


def test_forward_sums_all_paths():
    model = small_model()
    texts = [[0, 1, 4], [2], [3, 3, 1, 0, 2]]
    sizes = np.array([len(x) for x in texts])
    got = hmm.forward(model, np.concatenate(texts), np.cumsum(sizes) - sizes, sizes)
    for text, value in zip(texts, got):
        total = sum(model.start[p[0]] * model.emit[text[0], p[0]] * math.prod(
            model.move[p[i - 1], p[i]] * model.emit[text[i], p[i]] for i in range(1, len(text)))
            for p in itertools.product(range(3), repeat=len(text)))
        assert value == pytest.approx(math.log(total))


def test_expected_counts_are_posteriors(monkeypatch):
    monkeypatch.setattr(hmm, "END", 4)
    model = small_model()
    text = [0, 3, 1, 1]
    start, moves, emitted = hmm.expected(model, np.array(text), np.array([0]), np.array([len(text)]))
    want = [np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))]
    total = 0
    for p in itertools.product(range(3), repeat=len(text)):
        w = model.start[p[0]] * model.emit[text[0], p[0]] * math.prod(
            model.move[p[i - 1], p[i]] * model.emit[text[i], p[i]] for i in range(1, len(text)))
        total += w
        want[0][p[0]] += w
        for i, s in enumerate(p):
            want[2][text[i], s] += w
            if i:
                want[1][p[i - 1], s] += w
    for a, b in zip((start, moves, emitted), want):
        assert np.allclose(a, b / total)


def texts(seed, n):
    draw = random.Random(seed)
    vocabulary = [["lumo", "kelta", "sanova", "mirti"], ["thrask", "gwold", "brunkh", "zwerg"]]
    return [" ".join(draw.choice(vocabulary[i % 2]) for _ in range(draw.choice([2, 10, 40]))) for i in range(n)]


def test_scores_equal_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(texts(2, 60))] + [(100, None), (101, ""), (102, "never seen Words"), (101, "lumo"), (None, "zwerg")]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(4)
    out = hmm.score(docs, F.col("doc_id") % 5 == 1).collect()
    assert len(out) == len(rows)
    counts = Counter()
    for i, t in rows:
        if i is None or i % 5 != 1:
            counts.update((t or "").lower().split())
            counts[None] += 1
    total, kinds = sum(counts.values()), len(counts)
    want = sorted((i is not None and i % 5 == 1, len(w) + 1, sum(counts[x] > 0 for x in w + [None]), total, round(sum(
        math.log10((counts[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in w + [None]), 9))
        for i, w in ((i, (t or "").lower().split()) for i, t in rows))
    assert sorted((r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 9)) for r in out) == want
    held = [r for r in out if r.held_out and r.n_tokens > 5]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id int, text string")
    assert hmm.score(docs.limit(0), F.lit(False)).count() == 0
    row = hmm.score(docs, F.lit(True)).first()
    assert (row.train_tokens, row.n_known, row.held_out) == (0, 0, True) and math.isfinite(row.score)


def test_packing():
    codes = np.array([0, 1, 70000, 5, 1 << 25], np.int32)
    assert hmm.unpacked(hmm.packed(codes), 5).tolist() == codes.tolist()
    assert hmm.unpacked(hmm.packed(codes[:0]), 0).tolist() == []


def kneser_ney_brute(corpus, order):
    """A plain version: (history, byte) -> probability."""
    counts = [Counter() for _ in range(order + 1)]
    for text in corpus:
        data = bytes(order) + text.encode()
        for i in range(order, len(data)):
            counts[order][data[i - order + 1:i + 1]] += 1
    for k in range(order - 1, 0, -1):
        for gram in counts[k + 1]:
            counts[k][gram[1:]] += 1

    def discount(k, c):
        n = Counter(counts[k].values())
        if not n[1] or not n[2]:
            return [0.5, 0.75, 1.0][min(c, 3) - 1]
        y, i = n[1] / (n[1] + 2 * n[2]), min(c, 3)
        return min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.0), float(i)) if n[i] else i * 0.5

    def p(history, byte, k):
        if k == 0:
            return 1 / 256
        history = history[len(history) - k + 1:] if k > 1 else b""
        own = {g: c for g, c in counts[k].items() if g[:-1] == history}
        below = p(history[1:] if k > 1 else b"", byte, k - 1)
        if not own:
            return below
        total = sum(own.values())
        c = own.get(history + byte, 0)
        left = max(c - discount(k, c), 0) / total if c else 0
        return left + sum(discount(k, x) for x in own.values()) / total * below

    return p


@pytest.mark.parametrize("shard", [32 << 20, 2000])
def test_perplexity_equals_a_plain_model(spark, monkeypatch, shard):
    monkeypatch.setattr(kn, "SHARD_BYTES", shard)
    corpus = ["abra cadabra", "abba", "cab", "abracadabra", "é", "bad cab"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(corpus + ["dabb zé", "", None, "a"])], "doc_id int, text string")
    model = kn.fit(docs.where(f"doc_id < {len(corpus)}"))
    p = kneser_ney_brute(corpus, kn.ORDER)
    for r in kn.perplexities(docs, model).collect():
        data = bytes(kn.ORDER) + (r.text or "").encode()
        n = len(data) - kn.ORDER
        assert r.n_bytes == n
        if not n:
            assert r.perplexity is None
            continue
        total = sum(math.log(p(data[i - kn.ORDER + 1:i], data[i:i + 1], kn.ORDER)) for i in range(kn.ORDER, len(data)))
        assert r.perplexity == pytest.approx(math.exp(-total / n), rel=1e-4)
    history = b"\0" + b"abra"
    assert sum(p(history, bytes([b]), kn.ORDER) for b in range(256)) == pytest.approx(1)


def test_model_is_fitted_on_all_trusted_texts(spark, monkeypatch):
    rows = spark.range(1500).select(F.col("id").alias("doc_id"), F.lit("xx").alias("lang"),
                                    F.repeat(F.concat(F.sha2(F.col("id").cast("string"), 256), F.lit(" ")), 70).alias("text"))
    fitted, fit = [], kn.fit

    def counted(docs, text="text"):
        fitted.extend(r.doc for r in docs.select("doc").collect())
        return fit(docs, text)

    monkeypatch.setattr(kn, "fit", counted)
    got = kn.classify(rows, rows.select("doc_id", F.lit(1).alias("quality"))).collect()
    wanted = [i for i in range(1500) if zlib.crc32(str(i).encode()) % kn.HELD_OUT]
    assert len(got) == 1500 and sorted(fitted) == wanted


@pytest.mark.parametrize("bits", [64, 1 << 26])
def test_likely_ids_hold_all_wanted_ones(spark, monkeypatch, bits):
    monkeypatch.setattr(kn, "ID_BITS", bits)
    docs, ids = spark.range(3000).select(F.col("id").alias("doc")), spark.range(0, 3000, 7).select(F.col("id").alias("doc"))
    found = [r.doc for r in kn.likely_among(docs, ids).collect()]
    assert len(found) == len(set(found)) and set(found) >= set(range(0, 3000, 7))
    assert bits == 64 or len(found) == len(range(0, 3000, 7))
    assert kn.likely_among(docs, ids.select(F.col("doc").cast("string").alias("doc"))).count() == 3000
    assert kn.likely_among(docs, ids.limit(0)).count() == 0


@pytest.mark.parametrize("chunk", [300, 100_000])
def test_chunks_and_shards_do_not_change_perplexities(spark, monkeypatch, chunk):
    corpus = texts(9, 60)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(corpus + ["", None, "zz"])], "doc_id int, text string").coalesce(2)
    model = kn.fit(docs.where("doc_id < 30"))
    whole = {r.doc_id: (r.n_bytes, r.perplexity) for r in kn.perplexities(docs, model).collect()}
    monkeypatch.setattr(kn, "SHARD_BYTES", 4000)
    monkeypatch.setattr(kn, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(kn, "PART_BYTES", 200)
    cut = {r.doc_id: (r.n_bytes, r.perplexity) for r in kn.perplexities(docs, model).collect()}
    assert cut.keys() == whole.keys() == set(range(63)) and cut[60] == cut[61] == (0, None)
    for i, (n, value) in whole.items():
        assert cut[i] == (n, value and pytest.approx(value, rel=1e-6))


def test_classifier_keeps_clean_and_drops_junk(spark):
    draw = random.Random(4)
    rows = [(i, t, "xx") for i, t in enumerate(texts(6, 200))]
    rows += [(1000 + i, "".join(draw.choice("#$%&QXZJ 0") for _ in range(80)), "xx") for i in range(20)] + [(2000, None, None), (2001, "", "yy")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 200, 3)] + [(1000, 0, 0), (0, 1, 1)], "doc_id int, quality int, toxic int")
    kept = {r.doc: r.kept for r in kn.classify(docs, labels).collect()}
    assert len(kept) == len(rows) and sum(kept[i] for i in range(200)) > 190
    assert not any(kept[i] for i in range(1000, 1020)) and not kept[2000] and not kept[2001]
    assert kn.classify(docs.limit(0), labels).count() == 0
    assert kn.classify(docs, labels.limit(0)).where("kept").count() == 220


EDGES = ["", None, " ", "  two  blanks ", "日本語 \U0001F600", "x\x00y", "a\n\n\tb", "ab" * 3000, "▁marker", "é" * 10, "<s> </s> <0x41>"]


def test_pieces_agree_and_come_back(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(EDGES)], "doc_id int, text string, ids int")
    out = pieces.encode(docs)
    rows = out.collect()
    assert out.columns == ["doc_id", "text", "ids", "_ids", "n_tokens", "parity", "round_trip"]
    assert all(r.parity for r in rows)
    assert [r.doc_id for r in rows if not r.round_trip] == [EDGES.index("▁marker")]
    assert all(r.n_tokens == len(r._ids) for r in rows)
    back = {r.doc_id: r.decoded for r in pieces.decode(out.drop("ids"), ids="_ids").collect()}
    assert all(back[i] == (t or "").replace("▁", " ") for i, t in enumerate(EDGES))
    assert pieces.encode(docs.limit(0)).count() == 0


def test_texts_are_merged_whole():
    import sentencepiece
    with open(pieces.MODEL, "rb") as file:
        data = file.read()
    ours, theirs = pieces.backend(pieces.parse(data)), sentencepiece.SentencePieceProcessor(model_proto=data)
    back = pieces.decoding(pieces.parse(data))
    assert len(ours.pre_tokenizer.pre_tokenize_str("▁one▁▁two\nthree▁")) == 1  # words are not cut apart
    for text in [t or "" for t in EDGES] + ["one two " * 40_000, " " * 999 + "x" + " " * 40, "▁ ▁▁ x▁y", "(  a  )\t " * 500]:
        ids = ours.encode(text, add_special_tokens=False).ids
        assert ids == theirs.encode(text)
        assert all(x.decode(ids, skip_special_tokens=False) == text.replace("▁", " ") for x in (ours, back))
    fake = [theirs.piece_to_id(p) for p in ("a", "<0xE2>", "<0x96>", "<0x81>", "▁▁", "b")]
    assert all(x.decode(fake, skip_special_tokens=False) == "a▁  b" for x in (ours, back))  # bytes of a marker are no blank


def test_packed_texts_are_not_shuffled(spark):
    docs = spark.createDataFrame([(i, f"text {i} of some words") for i in range(300)] + [(300, None), (301, "")], "doc_id int, text string")
    model = kn.fit(docs.where("doc_id < 30"))
    found = kn.perplexities(docs.repartition(5), model)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(chunk", plan)) == 1  # the answers only
    assert len(found.collect()) == 302 and not spark.catalog.listTables()


def varint(value):
    out = b""
    while value > 127:
        out, value = out + bytes([value & 127 | 128]), value >> 7
    return out + bytes([value])


def test_unigram_model_is_rebuilt():
    import sentencepiece
    import struct

    def message(number, data):
        return varint(number << 3 | 2) + varint(len(data)) + data

    def piece(text, score, kind):
        return message(1, message(1, text.encode()) + varint(2 << 3 | 5) + struct.pack("<f", score) + varint(3 << 3) + varint(kind))

    words = ["▁", "a", "b", "c", "ab", "▁ab", "abc", "▁c", "bc"]
    data = piece("<unk>", 0, 2) + b"".join(piece(f"<0x{i:02X}>", -20, 6) for i in range(256))
    data += b"".join(piece(w, -2.0 - 0.37 * i, 1) for i, w in enumerate(words))
    data += message(2, varint(3 << 3) + varint(1) + varint(35 << 3) + varint(1))
    data += message(3, varint(3 << 3) + varint(1) + varint(4 << 3) + varint(0))
    model = pieces.parse(data)
    assert (model.kind, model.byte_fallback, len(model.pieces)) == (pieces.UNIGRAM, True, 266)
    ours, theirs = pieces.backend(model), sentencepiece.SentencePieceProcessor(model_proto=data)
    for text in ("abc abab", "cab  bca", "é abc", "abcabcab"):
        assert ours.encode(text, add_special_tokens=False).ids == theirs.encode(text)


def test_word_classes_are_stable():
    from demandlens.llm.words import Words
    words = Words(pa.array(["the breathe a", "the"]))
    kinds = hmm.word_classes(words, np.arange(4))
    assert kinds[0] == kinds[3] and len({*kinds[:3].tolist()}) == 3 and re.match("int32", str(kinds.dtype))
