import json
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlens.functions.lists import ordered_union, split_cells, split_skills
from demandlens.fixed_values import PROCESSED_FIELDS
from demandlens.operators.demand import market_demand, market_demand_for_role
from demandlens.operators.extract import extract_skills
from demandlens.plans import pipeline as L
from demandlens.schemas import GAPS, POSTINGS
from demandlens.sinks import messages as M
from demandlens.sinks import tables as K
from demandlens.sinks.snapshots import Snapshots
from demandlens.sources import external, messages, tables, uploads
from demandlens.streaming import extraction as E
from demandlens.streaming.demand import running_demand, start_demand
from demandlens.taxonomy import taxonomy_table


SENTENCES = ("Needs Python, Docker and Teamwork.", "SQL or PostgreSQL, with Git", "Nothing to see here", None,
             "Go and R, C++ and Node.js", "REST API and Unit Testing, Agile")


def posts_of(spark, ids):
    return spark.createDataFrame([(f"JP{i:04d}", f"title {i % 3}", "firm", SENTENCES[i % 6]) for i in ids],
                                 "posting_id string, title string, company string, description string")


def students_of(spark, n):
    return spark.createDataFrame(
        [(f"S{i:04d}", 5.0 + i % 5, i % 4, i % 3, i % 2, ["Python", "SQL", "Zork"][:i % 4], int(i % 5 + i % 2 > 2))
         for i in range(n)], "student_id string, cgpa double, projects_count int, certifications_count int, "
        "internships_count int, skills array<string>, placed int")


def test_splitters(spark):
    df = spark.createDataFrame([(None,), ("Python; ;SQL;nan",), ("",)], "c string")
    assert [r[0] for r in df.select(split_skills("c")).collect()] == [[], ["Python", "SQL"], []]
    assert [r[0] for r in df.select(split_cells("c", trim=True)).collect()] == [[], ["Python", "SQL", "nan"], []]
    assert df.select(ordered_union(F.array(F.lit("b"), F.lit("a")), F.array(F.lit("c"), F.lit("b")))).first()[0] == [
        "b", "a", "c"]


def test_messages_write_nulls(spark):
    df = spark.createDataFrame([("JP1", "Dev", "Python", 1.0), ("JP2", None, None, float("nan"))],
                               "posting_id string, title string, description string, score double")
    rows = [json.loads(r["value"]) for r in M.postings_to_messages(df).orderBy("key").collect()]
    assert rows[1] == {"posting_id": "JP2", "title": None, "description": None, "score": None}
    assert M.first_rows(df, 1).count() == 1 and M.first_rows(df).count() == 2


def test_message_processing(spark, taxonomy):
    raw = spark.createDataFrame([('{"posting_id":"JP1","title":"Dev","company":"X",'
                                  '"description":"Need Python, Docker and Teamwork."}',),
                                 ('{"posting_id":"JP2","description":null}',)], "value string")
    rows = {r["posting_id"]: r for r in E.process_postings(messages.decode(raw), taxonomy).collect()}
    assert rows["JP1"]["extracted_skills"] == "Python;Docker;Teamwork"
    assert "Programming Languages" in rows["JP1"]["skill_categories"]
    assert rows["JP2"]["extracted_skills"] == rows["JP2"]["skill_categories"] == ""
    assert rows["JP2"]["title"] is None and tuple(rows["JP1"].asDict()) == PROCESSED_FIELDS


def test_stream_equals_batch_and_restart_does_not_repeat(spark, taxonomy, tmp_path):
    posts = posts_of(spark, range(60))
    inbox, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    M.postings_to_messages(posts).repartition(5).select("value").write.text(inbox)
    for _ in range(2):
        E.start_extraction(messages.folder_stream(spark, inbox, 2), taxonomy, out, mark).awaitTermination()
    got = sorted(map(repr, spark.read.parquet(out).select(*PROCESSED_FIELDS).collect()))
    assert got == sorted(map(repr, E.process_postings(posts, taxonomy).collect())) and len(got) == 60
    M.postings_to_messages(posts_of(spark, range(60, 70))).select("value").write.mode(
        "append").text(inbox)
    query = E.start_extraction(messages.folder_stream(spark, inbox), taxonomy, out, mark, available_now=False,
                               every="0 seconds")
    E.run_until_idle(query, idle_seconds=8)
    assert not query.isActive and spark.read.parquet(out).count() == 70


def test_csv_edge(spark, tmp_path):
    path = str(tmp_path / "students")
    df = spark.createDataFrame(
        [("007", 8.5, 1, 2, 0, ["Python", 'a "b"', "nan"], 1), ("x", None, None, 0, 0, None, None)],
        "student_id string, cgpa double, projects_count int, certifications_count int, "
        "internships_count int, skills array<string>, placed int")
    K.export_csv(df, path)
    rows = {r["student_id"]: r for r in tables.students_from_csv(spark, path).collect()}
    assert rows["007"]["skills"] == ["Python", 'a "b"', "nan"] and rows["007"]["cgpa"] == 8.5
    assert rows["x"]["skills"] is None and rows["x"]["placed"] is None


def test_empty_and_missing_lists_survive_a_csv(spark, tmp_path):
    path = str(tmp_path / "students")
    df = spark.createDataFrame([("a", []), ("b", None), ("c", ["x"])], "student_id string, skills array<string>")
    K.export_csv(df, path)
    rows = {r["student_id"]: r["skills"] for r in tables.students_from_csv(spark, path).collect()}
    assert rows == {"a": [], "b": None, "c": ["x"]}


def test_csv_with_line_breaks(spark, tmp_path):
    (tmp_path / "p.csv").write_text('posting_id,title,description,true_skills\n'
                                    '1,"a ""q""","two\nlines; x",A;B\n2,NaN,N/A,\n')
    rows = tables.postings_from_csv(spark, str(tmp_path / "p.csv"), multi_line=True).orderBy("posting_id").collect()
    assert rows[0]["description"] == "two\nlines; x" and rows[0]["title"] == 'a "q"'
    assert rows[0]["true_skills"] == ["A", "B"] and rows[0]["company"] is None
    assert rows[1]["title"] is None and rows[1]["description"] is None and rows[1]["true_skills"] is None


def test_absent_tables(spark, tmp_path):
    empty = tables.read_table(spark, str(tmp_path / "no"), GAPS)
    assert empty.columns == GAPS.names and empty.count() == 0
    K.write_table(spark.range(3), str(tmp_path / "yes"))
    assert tables.ready(spark, [str(tmp_path / "yes")])
    assert not tables.ready(spark, [str(tmp_path / "yes"), str(tmp_path / "no")])
    assert tables.read_table(spark, str(tmp_path / "yes"), columns=["id"]).count() == 3
    pick = lambda paths: external.choose_source(
        spark, [str(tmp_path / p) for p in paths], lambda: "external", lambda: "generated", "parquet")
    assert pick(["yes"]) == "external" and pick(["yes", "no"]) == "generated"


def test_replace_a_table_with_its_own_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    K.write_table(spark.range(10), path)
    K.replace_table(spark.read.parquet(path).where("id > 4"), path)
    assert spark.read.parquet(path).count() == 5


def test_publish_skips_missing(spark, tmp_path):
    base = tmp_path / "base"
    K.write_table(spark.range(2), f"{base}/job_postings_skills")
    K.write_table(spark.range(2), f"{base}/market_skill_demand")
    keys = K.publish(spark, str(base), "/demo/latest/", str(tmp_path / "out"), K.PUBLISHED)
    assert keys == ["demo/latest/job_postings_skills", "demo/latest/market_skill_demand"]
    assert spark.read.parquet(str(tmp_path / "out" / keys[1])).count() == 2
    assert K.publish(spark, str(base), "//", str(tmp_path / "o2"), K.PUBLISHED)[0] == "job_postings_skills"


def test_external_files(spark):
    raw = spark.createDataFrame([(1, "A", "t", "d"), (2, None, None, "e"), (3, "B", "t", None)],
                                "job_id long, company_name string, title string, description string")
    posts = external.normalise_postings(raw)
    assert {r["posting_id"] for r in posts.collect()} == {"JP1", "JP2"} and posts.columns == POSTINGS.names
    assert external.normalise_postings(raw, n=1).count() == 1
    pupils = spark.createDataFrame([(7, 67.0, 91.0, 58.0, "Sci&Tech", "Mkt&HR", "No", "Placed"),
                                    (8, 70.0, 70.0, 70.0, "Zoo", None, "Yes", "Not Placed")],
                                   "sl_no int, ssc_p double, hsc_p double, degree_p double, degree_t string, "
                                   "specialisation string, workex string, status string")
    a, b = external.normalise_students(pupils).orderBy("student_id").collect()
    assert (a["student_id"], a["cgpa"], a["placed"], a["internships_count"]) == ("S0007", 7.2, 1, 0)
    assert a["skills"] == sorted(set(a["skills"])) and "Python" in a["skills"] and "Leadership" in a["skills"]
    assert b["skills"] == [] and b["internships_count"] == 1


def test_uploads(spark, tmp_path):
    stored = {"postings": str(tmp_path / "postings"), "students": str(tmp_path / "students")}
    posts = tmp_path / "p.csv"
    posts.write_text("title,company,description\nDev,X,Python\nDev,,\n")
    errors = uploads.accept_uploads(spark, stored, postings_csv=str(posts))
    assert errors == ["students: none uploaded and none stored"]
    bad = tmp_path / "s.csv"
    bad.write_text("cgpa,projects_count,certifications_count,internships_count,skills\nabc,1,1,1,SQL\n")
    assert "cgpa" in uploads.accept_uploads(spark, stored, str(posts), str(bad))[0]
    bad.write_text("cgpa,projects_count,certifications_count,internships_count,skills\n8,1,1,1,SQL; Git\n")
    assert uploads.accept_uploads(spark, stored, str(posts), str(bad)) == []
    row = spark.read.parquet(stored["students"]).first()
    assert row["student_id"] == "S0000" and row["skills"] == ["SQL", "Git"] and row["placed"] is None
    assert spark.read.parquet(stored["postings"]).count() == 1


def test_a_batch_longer_than_the_idle_time_is_kept(spark, taxonomy, tmp_path):
    inbox, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    M.postings_to_messages(posts_of(spark, range(40))).select("value").write.text(inbox)
    slow = F.udf(lambda x: __import__("time").sleep(0.2) or x)
    stream = messages.folder_stream(spark, inbox).coalesce(1).withColumn("title", slow("title"))
    query = E.start_extraction(stream, taxonomy, out, mark, available_now=False, every="0 seconds")
    E.run_until_idle(query, idle_seconds=2)
    assert not query.isActive and spark.read.parquet(out).count() == 40


def test_stream_with_a_vocabulary_beyond_the_plan(spark, tmp_path, monkeypatch):
    table = taxonomy_table(spark, {"x": [f"word{i} tail" for i in range(5001)] + ["Python"]})
    posts = spark.createDataFrame([("1", "t", "c", "word7 tail and PYTHON"), ("2", "t", "c", None)],
                                  "posting_id string, title string, company string, description string")
    inbox, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    M.postings_to_messages(posts).select("value").write.text(inbox)
    for _ in range(2):
        E.start_extraction(messages.folder_stream(spark, inbox), table, out, mark).awaitTermination()
    got = {r.posting_id: r.extracted_skills for r in spark.read.parquet(out).collect()}
    assert got == {"1": "word7 tail;Python", "2": ""}


def test_running_demand_equals_batch_demand_after_restarts(spark, taxonomy, tmp_path):
    inbox, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    rows = [(str(i), "Data Engineer" if i % 3 else None, "c", t) for i, t in enumerate(
        ["Python and SQL", "python", None, "", "Docker, Python", "none of it"] * 4)]
    posts = spark.createDataFrame(rows, "posting_id string, title string, company string, description string")
    whole = extract_skills(posts, taxonomy)
    for part in range(4):
        M.postings_to_messages(posts.where(F.col("posting_id").cast("int") % 4 == part)).select("value").coalesce(
            2).write.mode("append").text(inbox)
        stream = extract_skills(messages.folder_stream(spark, inbox, files_per_trigger=1), taxonomy)
        start_demand(stream, out, mark).awaitTermination()
        start_demand(stream, out + "-role", mark + "-role", role="engineer").awaitTermination()
    assert sorted(running_demand(spark, out).collect()) == sorted(
        market_demand(whole).select(*running_demand(spark, out).columns).collect())
    by_role = market_demand_for_role(whole, "engineer")
    assert sorted(running_demand(spark, out + "-role").select(*by_role.columns).collect()) == sorted(by_role.collect())
    # the stored results of an extraction stream do as well
    E.start_extraction(messages.folder_stream(spark, inbox), taxonomy, out + "-rows", mark + "-rows").awaitTermination()
    table = spark.read.parquet(out + "-rows")
    again = spark.readStream.schema(table.schema).parquet(out + "-rows").withColumn(
        "extracted_skills", F.split("extracted_skills", ";"))
    start_demand(again, out + "-two", mark + "-two").awaitTermination()
    assert sorted(running_demand(spark, out + "-two").collect()) == sorted(running_demand(spark, out).collect())


def test_list_columns_travel_as_text(spark):
    df = spark.createDataFrame([("1", ["A", "B"]), ("2", None)], "posting_id string, true_skills array<string>")
    back = {r.posting_id: r.true_skills for r in messages.decode(M.postings_to_messages(df)).collect()}
    assert back == {"1": "A;B", "2": ""}


def test_a_failure_leaves_all_old_tables(spark, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    K.write_table(spark.range(1), one)
    K.write_table(spark.range(2), two)
    broken = spark.range(5).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception):
        K.replace_tables(spark, {one: spark.range(9), two: broken})
    assert (spark.read.parquet(one).count(), spark.read.parquet(two).count()) == (1, 2)
    K.replace_tables(spark, {one: spark.read.parquet(two), two: spark.read.parquet(one)})
    assert (spark.read.parquet(one).count(), spark.read.parquet(two).count()) == (2, 1)


def test_readers_never_meet_a_missing_table(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "store"))
    assert store.read("a", T.StructType().add("id", "long")).count() == 0 and "a" not in store
    store.replace({"a": spark.range(1), "b": spark.range(1)})
    stop, seen, failed = threading.Event(), set(), []

    def reading():
        while not stop.is_set():
            try:
                seen.add(store.read("a").count())
            except Exception as error:
                failed.append(error)

    reader = threading.Thread(target=reading)
    reader.start()
    for n in range(2, 8):
        store.replace({"a": store.read("a").union(spark.range(1)), "b": spark.range(n)})
    stop.set()
    reader.join()
    assert not failed and seen <= set(range(1, 8))
    assert (store.read("a").count(), store.read("b").count(), store.current()[0]) == (7, 7, 7)
    with pytest.raises(Exception):
        store.replace({"a": spark.range(9), "b": spark.range(5).select(F.raise_error(F.lit("no")).alias("id"))})
    assert (store.read("a").count(), store.current()[0]) == (7, 7)
    assert len(store.vacuum(keep=2)) == 10 and store.vacuum(keep=2) == []
    assert (store.read("a").count(), store.read("b").count()) == (7, 7)


def test_two_writers_take_different_numbers(spark, tmp_path):
    one, two = (Snapshots(spark, str(tmp_path / "store")) for _ in range(2))
    assert one._commit(1, {"a": "x"}) and not two._commit(1, {"b": "y"})
    assert two.replace({"b": spark.range(3)}) == 2
    assert set(one.current()[1]) == {"a", "b"} and one.current()[1]["a"] == "x"


def test_uploads_into_a_store(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "store"))
    posts, people = tmp_path / "posts.csv", tmp_path / "people.csv"
    posts.write_text("title,company,description\nEngineer,Firm,Needs Python\n")
    people.write_text("cgpa,projects_count,certifications_count,internships_count,skills\n8,1,1,1,\n")
    assert uploads.accept_uploads(spark, store, str(posts)) != [] and store.current()[0] == 0
    assert uploads.accept_uploads(spark, store, str(posts), str(people)) == []
    assert uploads.accept_uploads(spark, store, students_csv=str(people)) == [] and store.current()[0] == 2
    assert store.read("students").first()["skills"] == [] and store.read("postings").count() == 1


def test_bloom_filters_skip_row_groups(spark, tmp_path):
    students = spark.range(40_000).select(F.md5(F.col("id").cast("string")).alias("student_id"), F.col("id").alias("x"))

    def rows_read(path, value):
        found = spark.read.parquet(path).where(F.col("student_id") == value)
        found.collect()
        leaf = found._jdf.queryExecution().executedPlan().collectLeaves().head()
        return leaf.metrics().apply("numOutputRows").value()

    for name, lookup in (("plain", ()), ("bloom", ["student_id"])):
        K.write_table(students.repartition(4), f"{tmp_path}/{name}", lookup)
    known = students.where("x = 7").first().student_id
    absent = known[:-1] + ("0" if known[-1] != "0" else "1")
    assert rows_read(f"{tmp_path}/plain", absent) == 40_000 and rows_read(f"{tmp_path}/bloom", absent) < 40_000
    assert 0 < rows_read(f"{tmp_path}/bloom", known) < 40_000


def test_an_unreadable_table_is_an_error(spark, tmp_path):
    (tmp_path / "bad").mkdir()
    with pytest.raises(Exception):
        tables.read_table(spark, str(tmp_path / "bad"), GAPS)


def test_pipeline(spark, taxonomy, tmp_path):
    ingest = lambda: (posts_of(spark, range(80)).withColumn("true_skills", F.lit(None).cast("array<string>")),
                      students_of(spark, 120))
    paths = L.Paths(str(tmp_path))
    assert not L.pipeline_ready(spark, paths)
    done = L.run_pipeline(spark, str(tmp_path), taxonomy, ingest, rounds=2)
    assert done.failed is None and done.finished == ["ingest", "extract", "features", "index", "train"]
    assert L.pipeline_ready(spark, paths)
    gaps = spark.read.parquet(paths.student_skill_gaps)
    bounds = gaps.agg(F.min("market_alignment_score"), F.max("market_alignment_score")).first()
    assert gaps.count() == 120 and 0 <= bounds[0] <= bounds[1] <= 1
    assert spark.read.json(paths.model_metrics).first()["best_model"]
    assert spark.read.parquet(paths.placement_scores).where("tier = 'Unknown'").count() == 0
    assert len(K.publish(spark, paths.base, "x", str(tmp_path / "bucket"), K.PUBLISHED)) == 6


def test_a_rerun_starts_at_the_failed_stage(spark, taxonomy, tmp_path, monkeypatch):
    ingest = lambda: (posts_of(spark, range(20)).withColumn("true_skills", F.lit(None).cast("array<string>")),
                      students_of(spark, 30))
    run = lambda **more: L.run_pipeline(spark, str(tmp_path), taxonomy, ingest, retrain=False, resume=True, **more)
    with monkeypatch.context() as broken:
        broken.setattr(L, "features_stage", lambda *_: 1 / 0)
        done = run()
    assert (done.finished, done.failed) == (["ingest", "extract"], "features")
    done = run()
    assert (done.skipped, done.finished) == (["ingest", "extract"], ["features", "index", "train"])
    assert run().skipped == ["ingest", "extract", "features", "index", "train"]
    # a table that was changed since is made again, with what hangs on it
    K.replace_table(spark.read.parquet(f"{tmp_path}/students").limit(7), f"{tmp_path}/students")
    assert run().finished[:1] == ["ingest"]
    done = run(source="2")
    assert "ingest" in done.finished and "extract" in done.finished
    other = L.run_pipeline(spark, str(tmp_path), taxonomy_table(spark, {"x": ["Git"]}), ingest, retrain=False, resume=True, source="2")
    assert other.skipped == ["ingest"] and other.failed is None


def test_pipeline_stops_at_the_failing_stage():
    def fail():
        raise RuntimeError("broken")
    seen = []
    done = L.run_stages([("one", lambda: seen.append(1)), ("two", fail), ("three", lambda: seen.append(3))])
    assert (done.finished, done.failed, seen) == (["one"], "two", [1])
    with pytest.raises(RuntimeError):
        raise done.error
