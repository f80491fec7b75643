"""The queries without SQL, over whole given tables, against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter
from itertools import combinations
from pathlib import Path

import pytest
from compare import connect
from demandlens.llm import catalog, centroids, kneser_ney
from pyspark.sql import functions as F
from test_privacy_and_rules import base as pii

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test data")
LOWER = {ord(a): ord(a.lower()) for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


@pytest.fixture(scope="module")
def docs():
    rows = connect(SF).execute("SELECT doc_id, text, lang FROM documents").fetchall()
    return {i: (text or "", lang) for i, text, lang in rows}


def run(spark, name):
    rows = catalog.QUERIES[name](spark, SF).collect()
    found = {r.doc_id: r for r in rows}
    assert len(found) == len(rows)
    return found


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))


def test_op1(spark, docs):
    got, counts = run(spark, "op1_lm_scoring"), Counter()
    words = {i: [*words_of(t), None] for i, (t, _) in docs.items()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in docs}
    for i, w in words.items():
        if not held[i]:
            counts.update(w)
    total, kinds = sum(counts.values()), len(counts)
    for i, w in words.items():
        score = sum(math.log10((counts[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in w)
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(w), sum(counts[x] > 0 for x in w), total)
        assert r.base_score == pytest.approx(score)
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_op2(spark, docs):
    got = run(spark, "op2_language_id")
    held = [i for i in docs if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i, r in got.items() if r.held_out} == set(held)
    assert sum(got[i].lang_pred == docs[i][1] for i in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def trigrams(text):
    """Counts of the hashed byte trigrams of a text around each of its letters."""
    folded = bytearray(b" ")
    for b in text.encode():
        b = b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32
        if b != 32 or folded[-1] != 32:
            folded.append(b)
    if folded[-1] != 32:
        folded.append(32)
    out = Counter()
    for i in range(len(folded) - 2):
        code = folded[i] << 16 | folded[i + 1] << 8 | folded[i + 2]
        if folded[i + 1] != 32:
            out[(code * 0x9E3779B1 & 0xFFFFFFFF) >> 32 - centroids.BITS] += 1
    return out


def test_op2_is_the_nearest_centroid(spark, docs):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    learn = {i: d for i, d in docs.items() if zlib.crc32(str(i).encode()) % 4 != 2}
    model = centroids.train(table.where(F.col("doc_id").isin(list(learn))))
    known = [trigrams(t) for t, lang in learn.values() if lang and re.search(r"[^\W\d_]", t)]
    df = Counter(k for x in known for k in x)
    for k in range(0, centroids.FEATURES, 7):
        assert model.idf[k] == pytest.approx(math.log((1 + len(known)) / (1 + df[k])) + 1, rel=1e-5)
    assert len(set(model.languages)) == len({lang for _, lang in learn.values() if lang})
    for i, r in run(spark, "op2_language_id").items():
        text = docs[i][0]
        if not re.search(r"[^\W\d_]", text):
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        weights = {k: math.log(1 + n) * float(model.idf[k]) for k, n in trigrams(text).items()}
        size = math.sqrt(sum(w * w for w in weights.values())) or 1
        cosines = [sum(w * float(c[k]) for k, w in weights.items()) / size for c in model.centres]
        assert r.score == pytest.approx(max(cosines), abs=1e-4)
        assert cosines[[j for j, x in enumerate(model.languages) if x == r.lang_pred][0]] >= 0
        best = max(c for c, x in zip(cosines, model.languages) if x == r.lang_pred)
        assert best == pytest.approx(max(cosines), abs=1e-4)


def test_op3(spark, docs):
    for i, r in run(spark, "op3_pii").items():
        want = pii(docs[i][0])
        kinds = Counter(k for k, _, _ in want)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds[k] for k in ("email", "ip", "card", "phone"))
        assert r.base_sha256 == hashlib.sha256(joined(want).encode()).hexdigest() and r.spans.startswith(joined(want))


def test_op4(spark, docs):
    rules = (("assign", r"""(?ai:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
             ("access", r"(AKIA[A-Z0-9]+)", 20), ("hex", r"([0-9a-f]+)", 24))
    for i, r in run(spark, "op4_secret_scans").items():
        want = [(k, m.start(), m.end()) for k, p, n in rules for m in re.finditer(p, docs[i][0]) if len(m[1]) >= n]
        want.sort(key=lambda s: (s[1], [k for k, *_ in rules].index(s[0])))
        kinds = Counter(k for k, _, _ in want)
        assert (r.n_assign, r.n_access, r.n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert r.base_sha256 == hashlib.sha256(joined(want).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("guess")] == [s for s in joined(want).split(",") if s]


def test_op5(spark, docs):
    import sentencepiece
    from demandlens.llm.pieces import MODEL
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for i, r in run(spark, "op5_sentencepiece").items():
        ids = model.encode(docs[i][0])
        assert (r.n_tokens, r.parity, r.round_trip) == (len(ids), True, True)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_op8(spark, docs):
    got = run(spark, "op8_quality_classifier")
    labels = dict(connect(SF).execute("SELECT doc_id, quality FROM labels").fetchall())
    good, bad = ([got[i].kept for i in labels if labels[i] == q and i in got] for q in (1, 0))
    assert sum(good) >= 0.9 * len(good) and (not bad or sum(bad) / len(bad) < sum(good) / len(good))

    def quantile(values, share):
        return sorted(values)[max(math.ceil(share * len(values)), 1) - 1] if values else None

    trusted = [r for i, r in got.items() if labels.get(i) == 1 and r.perplexity is not None]
    left_out = [r for r in trusted if zlib.crc32(str(r.doc_id).encode()) % kneser_ney.HELD_OUT == 0]
    low, high = quantile([r.perplexity for r in trusted], kneser_ney.LOW), quantile([r.perplexity for r in left_out], kneser_ney.HIGH)
    for r in got.values():
        own = [x.perplexity for x in trusted if x.lang == r.lang]
        far = [x.perplexity for x in left_out if x.lang == r.lang]
        a, b = quantile(own, kneser_ney.LOW), quantile(far, kneser_ney.HIGH)
        a, b = low if a is None else a, high if b is None else b
        if len(far) < kneser_ney.FEW:
            a, b = min(a, low), max(b, high)
        assert (r.low, r.high) == (pytest.approx(a / kneser_ney.SLACK), pytest.approx(b * kneser_ney.SLACK))
        assert r.kept == (r.perplexity is not None and r.low <= r.perplexity <= r.high)


def test_op9(spark, docs):
    got, sets = run(spark, "op9_minhash_near_dedup"), {}
    for i, (text, _) in docs.items():
        w = words_of(text)
        sets[i] = {tuple(w[k:k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()
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
    for i, r in got.items():
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[i]), find(i), find(i) == i)
