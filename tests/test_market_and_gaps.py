import random

import pytest
from pyspark.sql import functions as F

from demandlens.operators import demand as D
from demandlens.operators import gaps as G
from demandlens.taxonomy import categories, taxonomy_table


def students_of(spark, rows):
    return spark.createDataFrame(rows, "student_id string, skills array<string>")


def test_demand_of_nothing_has_columns(spark):
    df = spark.createDataFrame([(None,), ([""],)], "extracted_skills array<string>")
    out = D.market_demand(df)
    assert out.columns == ["skill", "posting_count", "pct_postings", "demand_rank"]
    assert out.collect() == []


def test_demand_counts_elements_over_all_postings(spark):
    df = spark.createDataFrame([(["Python", "SQL"],), (["Python"],), (None,), (["SQL", "Docker"],)],
                               "extracted_skills array<string>")
    rows = [tuple(r) for r in D.market_demand(df).orderBy("demand_rank").collect()]
    assert rows == [("Python", 2, 0.5, 1), ("SQL", 2, 0.5, 2), ("Docker", 1, 0.25, 3)]
    repeated = spark.createDataFrame([(["A", "A"],)], "extracted_skills array<string>")
    assert D.market_demand(repeated).first()["posting_count"] == 2


def test_role_filter_is_literal(spark):
    df = spark.createDataFrame([("Data Engineer", ["SQL"]), ("C++ (data)", ["C"]), (None, ["Go"])],
                               "title string, extracted_skills array<string>")
    count = lambda role: {r["skill"] for r in D.market_demand_for_role(df, role).collect()}
    assert count("data") == {"SQL", "C"}
    assert count("engineer") == {"SQL"}
    assert count("(DATA)") == {"C"}
    assert count("d.ta") == count("zzz") == set()
    assert count("  ") == {"SQL", "C", "Go"}


def test_top_skills_gives_what_is_asked(spark, market):
    table = market({f"s{i:02d}": 100 - i for i in range(60)}, 100)
    assert D.top_skills(table).count() == 20
    for asked, given in ((1, 1), (7, 7), (100, 60)):
        assert D.top_skills(table, asked).count() == given


def test_scaled_demand(spark, market):
    rows = {r.skill: r.scaled for r in D.scaled_demand(market({"a": 4, "b": 1})).collect()}
    assert rows == {"a": 1.0, "b": 0.25}


def test_kpis_and_tree(spark, taxonomy, market):
    postings = spark.createDataFrame([(["Python", "SQL"],), (["Python"],), ([],), (["Zork"],)],
                                     "extracted_skills array<string>")
    table = D.market_demand(postings)
    assert tuple(D.market_kpis(postings, table).first()) == (4, 3, "Python", 0.5, 1.0)
    tree = {(r["category"], r["skill"]): r["posting_count"]
            for r in D.demand_tree(table, taxonomy).collect()}
    assert tree[("Programming Languages", None)] == 3
    assert tree[("Other", "Zork")] == 1 and tree[(None, None)] == 4


def test_gaps_tolerate_missing_skills(spark, market):
    students = students_of(spark, [("a", ["Python", "Git", "Git"]), ("b", None)])
    rows = {r["student_id"]: r for r in G.skill_gaps(students, market({"Python": 3, "SQL": 1})).collect()}
    assert rows["a"]["matched_skills"] == ["Python"]
    assert rows["a"]["market_alignment_score"] == 0.75 and rows["a"]["skill_count"] == 2
    assert rows["b"]["skill_count"] == 0 and rows["b"]["market_alignment_score"] == 0
    assert rows["b"]["missing_skills_ranked"] == ["Python", "SQL"]


def test_alignment_unrounded_and_without_demand(spark, market):
    students = students_of(spark, [("a", ["SQL"])])
    assert G.market_alignment(students, market({"Python": 3, "SQL": 1})).first()["alignment"] == 0.25
    assert G.market_alignment(students, market({"SQL": 1}).limit(0)).first()["alignment"] == 0
    assert G.skill_gaps(students, market({"SQL": 1}).limit(0)).first()["missing_skills_ranked"] == []
    third = G.market_alignment(students, market({"Python": 2, "SQL": 1})).first()["alignment"]
    assert third == 1 / 3


def test_inline_and_long_form_agree(spark, market, taxonomy):
    rng = random.Random(3)
    names = [s for c in ("a", "b", "c") for s in (f"{c}{i}" for i in range(30))]
    table = market({s: rng.randint(1, 9) for s in names}, 100)
    students = students_of(spark, [("all", names), ("none", []), ("null", None), ("x", ["a1"]), ("x", ["b1"]),
                                   (None, ["a1"]), (None, ["c1", "a1"]), ("x", ["a1"])] + [
        (f"s{i}", rng.choices(names + ["off1", "off2"], k=rng.randint(0, 60))) for i in range(40)])
    key = lambda df: sorted(map(repr, df.collect()))
    inline, long = G.skill_gaps(students, table), G._skill_gaps_long(students, table, 10)
    assert key(inline) == key(long.select(*inline.columns))
    aligned = G.market_alignment(students, table)
    empty = D.DemandProfile.load
    D.DemandProfile.load = classmethod(lambda cls, market, limit=0: None)
    try:
        assert key(aligned) == key(G.market_alignment(students, table).select(*aligned.columns))
    finally:
        D.DemandProfile.load = empty
    tax = taxonomy_table(spark, {c: [s for s in names if s[0] == c] for c in "cab"} | {"empty": ["zz"]})
    assert key(G.category_coverage(students, table, tax)) == key(
        G._category_coverage_long(students, table, tax))


def test_missing_and_matched_make_up_a_small_market(spark, market):
    table = market({"a": 3, "b": 2, "c": 1})
    row = G.skill_gaps(students_of(spark, [("x", ["c", "q"])]), table).first()
    assert sorted(row["matched_skills"] + row["missing_skills_ranked"]) == ["a", "b", "c"]


def test_coverage_lists_every_category(spark, market, taxonomy):
    table = market({"Python": 5, "Java": 5, "Docker": 2}, 10)
    rows = G.category_coverage(students_of(spark, [("a", ["Python"])]), table, taxonomy)
    found = {r["category"]: r["coverage"] for r in rows.collect()}
    assert list(found) == categories()
    assert found["Programming Languages"] == 0.5 and found["Big Data & Cloud"] == 0


def test_cohort_coverage_is_the_mean_over_all_students(spark, market, taxonomy):
    table = market({"Python": 5, "Java": 3, "Docker": 2}, 10)
    students = students_of(spark, [("a", ["Python", "Docker"]), ("b", None), ("c", ["Java", "Java"])])
    mean = {r["category"]: r["coverage"] for r in (
        G.category_coverage(students, table, taxonomy).groupBy("category")
        .agg(F.avg("coverage").alias("coverage"))).collect()}
    for row in G.cohort_coverage(students, table, taxonomy).collect():
        assert row["coverage"] == pytest.approx(mean[row["category"]])


def test_gap_detail_and_off_market(spark, market, taxonomy):
    table = market({"Python": 3, "Zork": 1})
    gaps = G.skill_gaps(students_of(spark, [("a", ["Java", "Java"])]), table)
    rows = [tuple(r)[1:] for r in G.gap_detail(gaps, table, taxonomy).orderBy("gap_rank").collect()]
    assert rows == [(1, "Python", "Programming Languages", 0.75, 3), (2, "Zork", "Other", 0.25, 1)]
    off = spark.range(1).select(G.off_market_skills(
        F.array(*map(F.lit, ["Java", "Python", "Java"])), F.array(F.lit("Python"))))
    assert off.first()[0] == ["Java", "Java"]


def test_results_do_not_depend_on_partitions(spark, market):
    table = market({"a": 3, "b": 2, "c": 1})
    students = students_of(spark, [(str(i), ["a"] * (i % 2) + ["c"] * (i % 3)) for i in range(50)])
    results = [sorted(map(repr, G.skill_gaps(students.repartition(n), table).collect())) for n in (1, 64)]
    assert results[0] == results[1]
