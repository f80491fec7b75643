import random
import statistics

import pytest
from pyspark.sql import functions as F

from demandlens.functions.numbers import risk_tier
from demandlens.operators import cohort as C
from demandlens.operators import placement as P
from demandlens.operators import ranking as R
from demandlens.operators import search as S
from demandlens.operators import whatif as H
from demandlens.operators.gaps import skill_gaps


def test_percentile_with_a_hot_value(spark):
    rng = random.Random(1)
    values = [0.5] * 400 + [round(rng.random(), 2) for _ in range(800)] + [None] * 5
    df = spark.createDataFrame(list(enumerate(values)), "id int, p double")
    for row in R.strict_percentile(df, "p", "pct").collect():
        if row["p"] is None:
            assert row["pct"] is None
        else:
            below = sum(v is not None and v < row["p"] for v in values)
            assert row["pct"] == pytest.approx(below / len(values))


@pytest.mark.parametrize("values", [[1.0] * 50, [1.0] * 30 + [2.0] * 30 + [3.0], [float(i // 7) for i in range(200)], []])
def test_percentile_of_values_over_several_ranges(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "id int, p double").repartition(5)
    got = {r.id: r.pct for r in R.strict_percentile(df, "p", "pct").collect()}
    assert got == {i: pytest.approx(sum(w < v for w in values) / len(values)) for i, v in enumerate(values)}


def test_no_row_is_joined_on_its_value(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(1)).alias("p"))
    plan = R.strict_percentile(df, "p", "pct")._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and all("_part" in line and "(p#" not in line for line in joins)


def test_exact_medians(spark):
    rng = random.Random(2)
    rows = [(rng.randint(0, 5), rng.random() if rng.random() < 0.9 else None) for _ in range(501)]
    df = spark.createDataFrame(rows, "a int, b double")
    found = R.exact_medians(df, ["a", "b"]).first()
    assert found["a"] == statistics.median(r[0] for r in rows)
    assert found["b"] == pytest.approx(statistics.median(r[1] for r in rows if r[1] is not None))


@pytest.mark.parametrize("n, hot", [(1, 0), (2, 0), (3, 2), (100_001, 0), (100_000, 40_000), (99_999, 70_000)])
def test_medians_of_many_values(spark, n, hot):
    rng = random.Random(n)
    values = [7.25] * hot + [rng.gauss(7, 3) for _ in range(n - hot)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    assert R.exact_medians(df, ["v"]).first()["v"] == statistics.median(values)
    assert R.exact_medians(df.limit(0), ["v"]).first()["v"] is None


def test_sequential_ids(spark):
    df = spark.createDataFrame([(f"k{i % 7}", i) for i in range(500)], "k string, i int").repartition(8)
    got = {r["i"]: r["row"] for r in R.sequential_ids(df, "row", "S", ["k", "i"]).collect()}
    order = sorted(range(500), key=lambda i: (f"k{i % 7}", i))
    assert got == {i: f"S{n:04d}" for n, i in enumerate(order)}
    read = spark.range(0, 100, 1, 4).withColumnRenamed("id", "i")
    assert {r["i"]: r["row"] for r in R.sequential_ids(read, "row", "S").collect()} == {
        i: f"S{i:04d}" for i in range(100)}


def test_no_single_task_window_on_large_input(spark):
    df = spark.range(100_000).withColumn("p", F.rand(1))
    plan = R.strict_percentile(df, "p", "pct")._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "SinglePartition" not in plan.split("Subquery")[0]


@pytest.mark.parametrize("n", [5, 12_000, 99_999])
def test_hash_sample(spark, n):
    df = spark.range(20_000)
    first = {r[0] for r in R.hash_sample(df, n, "id").collect()}
    assert len(first) == min(n, 20_000)
    if n < 20_000:
        ranked = df.orderBy(R.draw_long(42, F.col("id")), "id").limit(n)
        assert {r[0] for r in ranked.collect()} == first


def test_tiers(spark):
    df = spark.createDataFrame([(0.9,), (0.7,), (0.5,), (0.4,), (0.1,), (None,), (float("nan"),)], "p double")
    assert [r[0] for r in df.select(risk_tier(F.col("p"))).collect()] == [
        "On track", "On track", "Needs a push", "Needs a push", "At risk", "Unknown", "Unknown"]


@pytest.fixture
def small(spark, market):
    table = market({"a": 4, "b": 3, "c": 2, "d": 1}, 10)
    students = spark.createDataFrame(
        [("s1", 8.0, 1, 0, 0, ["a", "zz"], 1), ("s2", 6.0, 2, 1, 1, ["b", "b"], 0), ("s3", 7.0, 0, 0, 2, None, 1)],
        "student_id string, cgpa double, projects_count int, certifications_count int, "
        "internships_count int, skills array<string>, placed int")
    gaps = skill_gaps(students, table)
    scorer = P.linear_scorer(-5.0, {"cgpa": 0.5, "skill_count": 0.3, "market_alignment_score": 2.0})
    return students, gaps, table, scorer, C.score_cohort(C.feature_frame(students, gaps), scorer)


def test_cohort_views(spark, small):
    students, gaps, _, _, cohort = small
    tiers = {r["tier"]: r["students"] for r in C.tier_counts(cohort).collect()}
    assert list(tiers) == ["On track", "Needs a push", "At risk"] and sum(tiers.values()) == 3
    assert C.intervention_list(cohort, gaps, []).collect() == []
    listed = C.intervention_list(cohort, gaps, ["At risk", "Needs a push", "On track"])
    p = [r["probability"] for r in listed.collect()]
    assert p == sorted(p) and len(p) == 3
    assert C.cohort_kpis(cohort.drop("placed")).first()["placement_rate"] is None
    assert C.score_cohort(C.feature_frame(students, gaps)).first()["tier"] == "Unknown"
    assert sum(r["students"] for r in C.probability_histogram(cohort).collect()) == 3
    top = C.common_gaps(gaps, top=2).collect()
    assert [tuple(r) for r in top] == [("c", 3), ("d", 3)]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0, "x"), (0.039, "x"), (0.04, "x"), (1.0, "x"), (None, "x")],
                               "probability double, tier string")
    assert {r["bin"]: r["students"] for r in C.probability_histogram(df).collect()} == {1: 2, 2: 1, 25: 1}


def test_levers_follow_the_list_length(small):
    students, gaps, table, scorer, cohort = small
    rows = {(r["student_id"], r["skill"]): r["gain"] for r in H.levers(cohort, gaps, table, scorer).collect()}
    base = cohort.where("student_id = 's2'").first()
    import math
    z = -5.0 + 0.5 * 6.0 + 0.3 * 3 + 2.0 * (3 + 4) / 10  # two list entries plus one
    assert rows[("s2", "a")] == pytest.approx(1 / (1 + math.exp(-z)) - base["probability"])
    assert len(rows) == 3 + 3 + 4
    flat = P.linear_scorer(0, {"cgpa": 0.1})  # does not reward skills
    unmoved = C.score_cohort(C.feature_frame(students, gaps), flat)
    flags = {r["student_id"]: r["no_lever_helps"] for r in
             H.without_lever(H.levers(unmoved, gaps, table, flat)).collect()}
    assert flags == {"s1": True, "s2": True, "s3": True}


def test_scenario_overrides_and_keeps(small, spark):
    students, gaps, table, scorer, cohort = small
    plan = spark.createDataFrame([("s1", ["b", "a"], 9.0), ("s2", [], None)],
                                 "student_id string, add_skills array<string>, cgpa double")
    rows = {r["student_id"]: r for r in H.simulate(cohort, plan, table, scorer).collect()}
    assert rows["s1"]["new_skills"] == ["a", "zz", "b"] and rows["s1"]["new_alignment"] == 0.7
    assert rows["s2"]["skill_count"] == 1  # repeats removed here
    assert rows["s1"]["probability_gain"] > 0


def test_student_view(small, taxonomy):
    students, gaps, table, scorer, cohort = small
    view = H.student_view(cohort, gaps, table, taxonomy)
    row = H.student(view, "s1").first()
    assert row["off_market_skills"] == ["zz"] and row["matched_skills"] == ["a"]
    assert [g["skill"] for g in row["gap_table"]] == ["b", "c", "d"]
    assert row["cgpa_delta"] == 1.0 and 0 <= row["percentile"] < 1


def test_search(spark, tmp_path):
    postings = spark.createDataFrame(
        [(f"p{i}", "t", None if i % 2 else "co", ["hot"] + (["rare"] if i == 3 else [])) for i in range(30)]
        + [("p99", "t", "co", None)],
        "posting_id string, title string, company string, extracted_skills array<string>")
    docs = S.search_documents(postings)
    assert docs.count() == 31
    assert docs.where("posting_id = 'p99'").first()["extracted_skills"] == []
    index = S.posting_index(docs)
    S.write_index(index, str(tmp_path / "index"))
    stored = spark.read.parquet(str(tmp_path / "index"))
    assert stored.count() == 31
    hit = S.search_by_skill(stored, "rare").collect()
    assert [tuple(r) for r in hit] == [("rare", "p3", "t", "Unknown company")]
    assert S.search_by_skill(stored, "Hot").collect() == []
    plan = S.search_by_skill(stored, "rare")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(skill,rare)" in plan
    gaps = spark.createDataFrame([("s", ["hot", "nope"])], "student_id string, missing_skills_ranked array<string>")
    assert S.gap_postings(gaps, index, size=6).count() == 6
    assert S.postings_with_skill(docs, "rare").count() == 1


def test_bucketed_hits_are_joined_without_a_shuffle(spark, tmp_path):
    index = spark.range(500).select(F.concat(F.lit("s"), (F.col("id") % 40).cast("string")).alias("skill"),
                                    F.format_string("p%03d", "id").alias("posting_id"), F.lit("t").alias("title"),
                                    F.lit("c").alias("company"))
    S.write_hits(index, "hits_of_a_test", f"{tmp_path}/hits", size=3, buckets=8)
    rows = [("a", ["s1", "none", "s39"]), ("b", None), ("c", ["s1"]), ("d", [])]
    gaps = spark.createDataFrame(rows, "student_id string, missing_skills_ranked array<string>")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        found = S.gap_hits(gaps, spark.table("hits_of_a_test"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = {r.student_id: [(g.gap_rank, g.skill, [h.posting_id for h in g.hits]) for g in r.gaps]
               for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE hits_of_a_test")
    assert plan.count("hashpartitioning(skill") == 1  # of the gaps
    assert got == {"a": [(1, "s1", ["p001", "p041", "p081"]), (3, "s39", ["p039", "p079", "p119"])], "b": [],
                   "c": [(1, "s1", ["p001", "p041", "p081"])], "d": []}


def test_ids_follow_the_files_without_a_shuffle(spark, tmp_path):
    sizes = (3, 400, 1, 50)
    at = 0
    for i, n in enumerate(sizes):
        (spark.range(at, at + n).withColumn("pad", F.repeat(F.lit("x"), 10 * n)).coalesce(1)
         .write.parquet(str(tmp_path / f"t/part={i}")))
        at += n
    table = spark.read.parquet(str(tmp_path / "t")).select("id", "pad")
    out = R.sequential_ids(table, "key", "K")
    assert all(r.key == f"K{r.id:04d}" for r in out.select("key", "id").collect())
    assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r.key for r in R.sequential_ids(spark.range(5).withColumn("v", F.lit(1)), "key", "K").collect()} == {
        f"K{i:04d}" for i in range(5)}
