import random

import pytest
from pyspark.sql import functions as F

from demandlens.operators import extract as X
from demandlens.taxonomy import taxonomy_table


def found(spark, taxonomy, text, by_join=False):
    df = spark.createDataFrame([("1", text)], "posting_id string, description string")
    run = X._extract_by_join if by_join else X.extract_skills
    return run(df, taxonomy, "description").first()["extracted_skills"]


@pytest.mark.parametrize("text, skills", [
    ("We need someone strong in Python, React and Docker, with good Teamwork.",
     ["Python", "React", "Docker", "Teamwork"]),
    ("The weather today is sunny with a light breeze.", []),
    ("We need someone who can go above and beyond.", []),
    ("Backend written in Go, with a C client library.", ["Go", "C"]),
    ("Holds the AWS Certified Solutions Architect badge.", ["AWS Certified Solutions Architect"]),
    (None, []), ("   ", []),
    ("strong PYTHON and postgresql", ["Python", "PostgreSQL"]),
    ("Réaile C++ C# R&D", ["C++"]),
    ("ci/cd, SCIKIT-learn; node.JS Node.js", ["CI/CD", "scikit-learn", "Node.js"]),
    ("Python3 Python.Java unit\n testing", ["Python", "Java", "Unit Testing"]),
    ("SQL then Azure Fundamentals then SQL and azure", ["SQL", "Azure Fundamentals", "Azure"]),
])
def test_known_texts(spark, taxonomy, text, skills):
    assert found(spark, taxonomy, text) == skills


def greedy(tokens, phrases):
    """Brute force: all matches, longest first, then earliest, none overlapping."""
    spans = [(i, i + len(p), p) for p in phrases for i in range(len(tokens))
             if tokens[i:i + len(p)] == p]
    kept = []
    for s in sorted(spans, key=lambda s: (s[0] - s[1], s[0])):
        if all(s[1] <= k[0] or k[1] <= s[0] for k in kept):
            kept.append(s)
    names = [" ".join(k[2]) for k in sorted(kept)]
    return list(dict.fromkeys(names))


def test_overlaps_equal_brute_force_on_both_paths(spark):
    phrases = [p.split() for p in
               ("l m n", "n o", "o p", "a b", "b c", "c a", "a", "a a", "p l m", "m", "b c a b")]
    table = taxonomy_table(spark, {"x": [" ".join(p) for p in phrases]})
    rng = random.Random(7)
    texts = ["l m n o p", "a b c", "n o p x l m n o p"]
    texts += [" ".join(rng.choice("abclmnop") for _ in range(rng.randint(1, 40))) for _ in range(150)]
    texts.append(" ".join(rng.choice("abclmnop") for _ in range(3000)))
    df = spark.createDataFrame(list(enumerate(texts)), "posting_id int, description string")
    want = {i: greedy(t.split(), phrases) for i, t in enumerate(texts)}
    for result in (X.extract_skills(df, table),
                   X._extract_by_join(df, table, "description")):
        got = {r["posting_id"]: r["extracted_skills"]
               for r in result.select("posting_id", "extracted_skills").collect()}
        assert got == want


def test_join_path_keeps_case_rules_and_empty_rows(spark, taxonomy):
    assert found(spark, taxonomy, "go C Go c GO", by_join=True) == ["C", "Go"]
    assert found(spark, taxonomy, None, by_join=True) == []


def test_large_vocabulary_takes_the_join_path(spark, taxonomy, monkeypatch):
    monkeypatch.setattr(X, "INLINE_PHRASES", 10)
    monkeypatch.setattr(X.small_phrases, "__defaults__", (10,))
    df = spark.createDataFrame([("1", "Python and Docker")], "posting_id string, description string")
    result = X.extract_skills(df, taxonomy)
    assert "Join" in result._jdf.queryExecution().toString()
    assert result.first()["extracted_skills"] == ["Python", "Docker"]


def test_only_what_may_match_leaves_the_row(spark):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    vocabulary = sorted({" ".join(draw.choices(words, k=draw.choice([1, 2, 2, 3]))) for _ in range(6000)})
    table = taxonomy_table(spark, {"all": vocabulary})
    texts = [" ".join(draw.choices(words, k=200)) for _ in range(50)] + ["nothing of it", None]
    df = spark.createDataFrame(list(enumerate(texts)), "posting_id int, description string")
    known, wanted = {v.lower() for v in vocabulary}, 0
    for t in texts[:50]:
        toks = t.split()
        wanted += sum(" ".join(toks[i:i + n]) in known for n in (1, 2, 3) for i in range(len(toks) - n + 1))
    passed = X.candidates(df, table, "description")
    assert wanted <= passed.count() <= wanted + 0.08 * 3 * 200 * 50
    assert passed.where(F.lower("raw").isin(list(known)[:2000])).count() > 0
    rows = X._extract_by_join(df, table, "description").collect()
    assert len(rows) == 52
    for r in rows:
        toks = (texts[r.posting_id] or "").split()
        spans = sorted(((-n, i) for n in (1, 2, 3) for i in range(len(toks) - n + 1)
                        if " ".join(toks[i:i + n]) in known))
        taken, names = set(), []
        for n, i in spans:
            if not taken & set(range(i, i - n)):
                taken |= set(range(i, i - n))
                names.append((i, " ".join(toks[i:i - n])))
        assert r.extracted_skills == list(dict.fromkeys(n for _, n in sorted(names)))


def test_join_path_with_repeated_ids_and_copies(spark, taxonomy):
    rows = [("x", "Python")] * 20 + [("x", "Docker"), (None, "Go"), (None, "Python and Go")]
    df = spark.createDataFrame(rows, "posting_id string, description string")
    key = lambda d: sorted(repr(r) for r in d.select("posting_id", "mentions").collect())
    assert key(X._extract_by_join(df, taxonomy, "description")) == key(X.extract_skills(df, taxonomy))


def test_long_dotted_chain_does_not_overflow(spark, taxonomy):
    assert found(spark, taxonomy, "a" + ".b" * 50_000 + " Python") == ["Python"]


def test_empty_vocabulary(spark):
    table = taxonomy_table(spark, {})
    assert found(spark, table, "Python") == []


def test_categories_sorted_and_long_form(spark, taxonomy):
    df = spark.createDataFrame([("1", "Need Python, Docker and Teamwork."), ("2", "nothing")],
                               "posting_id string, description string")
    result = X.extract_skills(df, taxonomy)
    assert result.where("posting_id = '1'").first()["skill_categories"] == [
        "Big Data & Cloud", "Programming Languages", "Soft Skills"]
    long = [tuple(r) for r in X.job_skills(result).orderBy("first_pos").collect()]
    assert long == [("1", "Python", "Programming Languages", 1),
                    ("1", "Docker", "Big Data & Cloud", 3), ("1", "Teamwork", "Soft Skills", 5)]


def test_extraction_runs_once_without_a_shuffle(spark, taxonomy):
    df = spark.createDataFrame([("1", "Python")], "posting_id string, description string")
    for result in (X.extract_skills(df, taxonomy), X.job_skills(X.extract_skills(df, taxonomy))):
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert plan.count("regexp_extract_all") == 1


def test_quality_counts_sides(spark):
    df = spark.createDataFrame(
        [("1", ["a", "b"], ["a"]), ("2", [], ["a"]), ("3", ["a"], []), ("4", [], [])],
        "posting_id string, extracted_skills array<string>, true_skills array<string>")
    rows = {r["posting_id"]: (r["precision"], r["recall"])
            for r in X.extraction_quality(df).collect()}
    assert rows == {"1": (0.5, 1.0), "2": (0.0, 0.0), "3": (0.0, 0.0)}
    assert X.quality_summary(df).first()["mean_precision"] == pytest.approx(0.5 / 3)
    unlabelled = df.withColumn("true_skills", F.lit(None).cast("array<string>"))
    assert X.quality_summary(unlabelled).collect() == []
