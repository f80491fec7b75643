"""Suffix arrays and nearest centroids."""

import random
import re

import pytest
from demandlens.llm import centroids, suffix_arrays
from pyspark.sql import functions as F

LOWER = {ord(a): ord(a.lower()) for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, window):
    out = []
    for doc, text in docs:
        words, hit, found = words_of(text), set(), set()
        for item, item_text in items:
            own = words_of(item_text)
            size = min(window, len(own))
            for p in range(len(own) - size + 1) if own else ():
                for q in range(len(words) - size + 1):
                    if words[q:q + size] == own[p:p + size]:
                        hit |= set(range(q, q + size))
                        if item is not None:
                            found.add(str(item))
        out.append((doc, len(words), len(hit), sorted(found)))
    return sorted(out, key=repr)


def corpus(seed):
    draw = random.Random(seed)
    items = [(i, " ".join(draw.choice("abcdefgé") for _ in range(draw.choice([1, 3, 9, 14, 30])))) for i in range(8)]
    items += [(3, "a b a b a b a b a b a b a b"), (None, "null id item with quite a few words in its text here"), (90, None),
              (91, ""), (92, "..."), (4, items[4][1])]
    docs = []
    for i in range(40):
        parts = [" ".join(draw.choice("abcdefgé") for _ in range(draw.randrange(30)))]
        for _ in range(draw.randrange(3)):
            own = words_of(draw.choice(items)[1])
            at = draw.randrange(len(own) + 1)
            parts.append(", ".join(own[at:at + draw.randrange(1, 25)]).upper().replace("É", "é"))
            parts.append("x!y" * draw.randrange(3))
        docs.append((i, "\n".join(parts)))
    return docs + [(100, None), (101, ""), (101, "a b a b a b a b a b a"), (None, "a")], items


@pytest.mark.parametrize("window, block", [(10, 8 << 20), (4, 60), (2, 1)])
def test_hits_equal_brute_force(spark, window, block):
    docs, items = corpus(window)
    found = suffix_arrays.hits(spark.createDataFrame(docs, "doc_id int, text string").repartition(3),
                               spark.createDataFrame(items, "item_id int, text string"), window, block_bytes=block)
    got = sorted([(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.collect()], key=repr)
    assert got == brute(docs, items, window)


def test_longest_matches(spark):
    items = spark.createDataFrame([(1, "q0 a b c d e f g h q1 q2"), (2, "c d e f")], "item_id int, text string")
    docs = spark.createDataFrame([(7, "zz a b c d e f g h zz c d e f zz"), (8, "a b c")], "doc_id int, text string")
    got = {tuple(r) for r in suffix_arrays.longest_matches(docs, items, 4).collect()}
    assert {(7, "1", 1, 1, 8), (7, "2", 10, 0, 4), (7, "2", 3, 0, 4)} <= got
    assert all(doc == 7 and n >= 4 for doc, _, _, _, n in got)


def test_decontaminate_keeps_columns_and_clean_documents(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id int, text string")
    docs = spark.createDataFrame([(1, "x one two three four five six seven eight nine ten y", 4, "k"), (2, "one two three", 5, "k"),
                                  (3, None, 6, "k")], "doc_id int, text string, n_hit int, items string")
    out = suffix_arrays.decontaminate(docs, items)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [2, 3]
    assert suffix_arrays.decontaminate(docs, items.limit(0)).count() == 3
    assert suffix_arrays.longest_matches(docs, items.limit(0)).count() == 0
    assert suffix_arrays.decontaminate(docs.limit(0), items).count() == 0


WORDS = {"aa": ["lumo", "kelta", "sanova", "mirti", "pelo"], "bb": ["thrask", "gwold", "brunkh", "zwerg", "knorpt"]}


def labelled(spark, n=60):
    draw = random.Random(5)
    rows = [(i, " ".join(draw.choice(WORDS[lang]) for _ in range(draw.choice([3, 20, 60]))), lang)
            for i, lang in enumerate(["aa", "bb"] * (n // 2))]
    return spark.createDataFrame(rows, "doc_id int, text string, lang string")


def test_language_is_learned_and_rejected(spark):
    model = centroids.train(labelled(spark))
    assert set(model.languages) == {"aa", "bb"}
    test = spark.createDataFrame([
        (1, "sanova pelo lumo", "aa"), (2, "ZWERG brunkh", "bb"), (3, None, "und"), (4, "", "und"), (5, "12 345 !?", "und"),
        (6, "gwold " * 20000, "bb"), (7, "Ω愛", None)], "doc_id int, text string, score string")
    out = centroids.identify(test, model)
    assert out.columns == ["doc_id", "text", "score", "lang_pred", "_score", "accepted"]
    rows = {r.doc_id: r for r in out.collect()}
    assert all(rows[i].lang_pred == rows[i].score for i in range(1, 7))
    assert [rows[i].accepted for i in range(1, 7)] == [True, True, False, False, False, True]
    assert not rows[7].accepted and all(0 <= r._score <= 1 for r in rows.values())


def test_odd_training_rows_do_not_admit_another_language(spark):
    draw = random.Random(9)
    letters = {"aa": "aeiloumnst", "bb": "grkwzhbdut", "cc": "aeopyvcjqx"}
    words = {k: ["".join(draw.choice(v) for _ in range(draw.choice([2, 4, 6]))) for _ in range(60)] for k, v in letters.items()}

    def text(lang):
        return " ".join(draw.choice(words[lang]) for _ in range(40))

    rows = [(i, text(lang), lang) for i, lang in enumerate(["aa", "bb"] * 400)]
    rows += [(900, "cq", "aa"), (901, "xv", "bb")]  # odd texts among the labelled
    model = centroids.train(spark.createDataFrame(rows, "doc_id int, text string, lang string"))
    test = spark.createDataFrame([(i, text(lang), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 40)],
                                 "doc_id int, text string, lang string")
    kept = {lang: 0 for lang in words}
    for r in centroids.identify(test, model).where("accepted").collect():
        assert r.lang_pred == r.lang or r.lang == "cc"
        kept[r.lang] += 1
    assert kept["aa"] >= 39 and kept["bb"] >= 39 and kept["cc"] <= 2


def test_language_without_training_rows(spark):
    docs = labelled(spark).withColumn("lang", F.lit(None).cast("string"))
    out = centroids.identify(docs, centroids.train(docs))
    assert {(r.lang_pred, r.score, r.accepted) for r in out.select("lang_pred", "score", "accepted").distinct().collect()} == {("und", 0.0, False)}


def test_prediction_does_not_depend_on_neighbours(spark):
    docs = labelled(spark)
    model = centroids.train(docs)
    a = {r.doc_id: (r.lang_pred, round(r.score, 5)) for r in centroids.identify(docs, model).collect()}
    b = {r.doc_id: (r.lang_pred, round(r.score, 5)) for r in centroids.identify(docs.orderBy(F.rand(1)), model).collect()}
    assert a == b
