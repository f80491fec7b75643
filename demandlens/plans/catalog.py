"""Every operator as a query over the given tables.

A query takes (spark, sf_dir). List columns leave as ``;`` text and doubles
rounded, so that results can be compared by value.
"""

import uuid
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..fixed_values import FEATURES, STUDENT_NUMERIC
from ..functions.lists import join_skills, split_skills
from ..operators import cohort as C
from ..operators import demand as D
from ..operators import extract as X
from ..operators import gaps as G
from ..operators import placement as P
from ..operators import ranking as R
from ..operators import search as S
from ..operators import validate as V
from ..operators import whatif as H
from ..operators.boosting import fit_boosted
from ..operators.sketches import merged_sketches, sketched_medians, sketched_percentile, store_sketches
from ..operators.validate import may_retrain
from ..session import durable, scratch_path
from ..sinks.messages import postings_to_messages, send_to_folder
from ..schemas import STUDENTS
from ..sinks.snapshots import Snapshots
from ..sinks.tables import PUBLISHED, export_csv, publish, replace_table, write_metrics, write_table
from ..sources.external import choose_source, normalise_postings, normalise_students
from ..sources.messages import decode, folder_stream
from ..sources.tables import postings_from_csv, read_csv, read_table, students_from_csv
from ..sources.uploads import accept_uploads
from ..streaming.demand import running_demand, start_demand
from ..streaming.extraction import process_postings, run_until_idle, start_extraction
from ..taxonomy import taxonomy_table
from .pipeline import REQUIRED, Paths, pipeline_ready, run_pipeline
from .star import (OrderWorld, all_texts, customer_students, document_postings, document_taxonomy,
                   frozen_scorer, order_postings, order_texts, spread, table)


def _six(df, *columns):
    """Round to 6 decimals; adding 0.0 turns -0.0 into 0.0."""
    return df.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in columns})


def _text(df, *columns):
    return df.withColumns({c: join_skills(F.col(c)) for c in columns})


def _documents(spark, sf_dir):
    return X.extract_skills(document_postings(spark, sf_dir), document_taxonomy(spark))


# --- text extraction and market demand over documents -----------------------

def skill_mentions(spark, sf_dir):
    return X.job_skills(_documents(spark, sf_dir))


def mentions_by_join(spark, sf_dir):
    """The same mentions, found by the join that serves larger vocabularies."""
    found = X._extract_by_join(document_postings(spark, sf_dir), document_taxonomy(spark), "description")
    return X.job_skills(found)


def posting_skills(spark, sf_dir):
    return _text(_documents(spark, sf_dir).select(
        "posting_id", "extracted_skills", "skill_categories"),
        "extracted_skills", "skill_categories")


def market_demand(spark, sf_dir):
    return _six(D.market_demand(_documents(spark, sf_dir)), "pct_postings")


def demand_by_role(spark, sf_dir):
    return _six(D.market_demand_for_role(_documents(spark, sf_dir), "E"), "pct_postings")


def market_kpis(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    return _six(D.market_kpis(docs, D.market_demand(docs)), "top_share", "mean_skills")


def messages_json(spark, sf_dir):
    postings = document_postings(spark, sf_dir).withColumn("true_skills", F.array("title", "company"))
    return decode(postings_to_messages(postings))


def process_messages(spark, sf_dir):
    messages = decode(postings_to_messages(document_postings(spark, sf_dir)))
    return process_postings(messages, document_taxonomy(spark)).drop("description")


def stream_extract(spark, sf_dir):
    inbox, out, mark = (scratch_path(spark, n) for n in ("inbox", "extracted", "progress"))
    send_to_folder(postings_to_messages(document_postings(spark, sf_dir)), inbox)
    stream = folder_stream(spark, inbox, files_per_trigger=64)
    start_extraction(stream, document_taxonomy(spark), out, mark).awaitTermination()
    return spark.read.parquet(out).drop("description")


def _streamed_demand(spark, sf_dir, role=None):
    """Demand over two runs of one stream; the second goes on from the first's state."""
    inbox, out, mark = (scratch_path(spark, n) for n in ("inbox", "demand", "progress"))
    postings = document_postings(spark, sf_dir)
    late = F.pmod(F.crc32(F.col("posting_id").cast("string").cast("binary")), F.lit(2)) == 1
    for arrived in (postings.where(~late), postings.where(late)):
        send_to_folder(postings_to_messages(arrived), inbox, "append")
        stream = X.extract_skills(folder_stream(spark, inbox, files_per_trigger=8), document_taxonomy(spark))
        start_demand(stream, out, mark, role).awaitTermination()
    return running_demand(spark, out)


def stream_demand(spark, sf_dir):
    return _six(_streamed_demand(spark, sf_dir), "pct_postings")


def stream_demand_by_role(spark, sf_dir):
    return _six(_streamed_demand(spark, sf_dir, "e"), "pct_postings")


def stream_until_idle(spark, sf_dir):
    """The stream's results when it ran in batches until no message came."""
    inbox, out, mark = (scratch_path(spark, n) for n in ("inbox", "idle", "progress"))
    send_to_folder(postings_to_messages(document_postings(spark, sf_dir)), inbox)
    query = start_extraction(folder_stream(spark, inbox), document_taxonomy(spark), out, mark,
                             available_now=False, every="0 seconds")
    run_until_idle(query, idle_seconds=4)
    return spark.read.parquet(out).drop("description")


def nan_messages(spark, sf_dir):
    """Order prices as messages, those of urgent orders as NaN."""
    price = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(float("nan"))).otherwise(F.col("o_totalprice"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("posting_id"), price.alias("price"))
    sent = postings_to_messages(orders)
    return sent.select("key", F.get_json_object("value", "$.price").cast("double").alias("price"),
                       F.contains("value", F.lit('"price":null')).alias("written_as_null"))


def split_text_cells(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", F.size(split_skills("text")).alias("n_parts"),
                       F.md5(join_skills(split_skills("text"))).alias("parts_md5"))


# --- demand over orders ------------------------------------------------------

def market_demand_ranked(spark, sf_dir):
    return _six(OrderWorld(spark, sf_dir).market, "pct_postings")


def top_skills(spark, sf_dir):
    return _six(D.top_skills(OrderWorld(spark, sf_dir).market), "pct_postings")


def scaled_demand(spark, sf_dir):
    return _six(D.scaled_demand(OrderWorld(spark, sf_dir).market), "pct_postings", "scaled")


def demand_rollup(spark, sf_dir):
    world = OrderWorld(spark, sf_dir)
    tree = D.demand_tree(world.market, world.taxonomy)
    return tree.select(F.coalesce("category", F.lit("ALL")).alias("category"),
                       F.coalesce("skill", F.lit("ALL")).alias("skill"),
                       F.col("posting_count").cast("bigint").alias("posting_count"),
                       F.col("level").cast("int").alias("level"))


def demand_with_category(spark, sf_dir):
    world = OrderWorld(spark, sf_dir)
    return _six(D.with_category(world.market, world.taxonomy), "pct_postings")


# --- gaps and coverage -------------------------------------------------------

def skill_gaps(spark, sf_dir):
    return _text(OrderWorld(spark, sf_dir).gaps, "matched_skills", "missing_skills_ranked")


def alignment(spark, sf_dir):
    world = OrderWorld(spark, sf_dir)
    return _six(G.market_alignment(world.students, world.market)
                .select("student_id", "alignment"), "alignment")


def skill_gaps_long(spark, sf_dir):
    """The same gaps, by the joins that serve larger markets."""
    world = OrderWorld(spark, sf_dir)
    return _text(G._skill_gaps_long(world.stored_students, world.market, 10),
                 "matched_skills", "missing_skills_ranked")


def category_coverage_long(spark, sf_dir):
    world = OrderWorld(spark, sf_dir)
    return _six(G._category_coverage_long(world.stored_students, world.market, world.taxonomy),
                "coverage").drop("category_pos")


def off_market(spark, sf_dir):
    """Against the whole market; part types are skills that no posting asks for."""
    students = customer_students(spark, sf_dir, ("p_name", "p_type"))
    gaps = OrderWorld(spark, sf_dir).gaps_of(students.select("student_id", "skills"))
    both = students.select("student_id", "skills").join(gaps.select("student_id", "matched_skills"), "student_id")
    return _text(both.select("student_id", G.off_market_skills(
        "skills", F.col("matched_skills")).alias("off_market_skills")), "off_market_skills")


def gap_detail(spark, sf_dir):
    world = OrderWorld(spark, sf_dir)
    return _six(G.gap_detail(world.gaps, world.market, world.taxonomy), "demand")


def category_coverage(spark, sf_dir):
    world = OrderWorld(spark, sf_dir)
    return _six(G.category_coverage(world.students, world.market, world.taxonomy),
                "coverage").drop("category_pos")


def cohort_coverage(spark, sf_dir):
    world = OrderWorld(spark, sf_dir)
    return _six(G.cohort_coverage(world.students, world.market, world.taxonomy),
                "coverage").drop("category_pos")


# --- scored cohort -----------------------------------------------------------

def feature_frame(spark, sf_dir):
    return _six(OrderWorld(spark, sf_dir).features.drop("skills"), "cgpa", "market_alignment_score")


def score_cohort(spark, sf_dir):
    return _six(OrderWorld(spark, sf_dir).cohort.select(
        "student_id", "market_alignment_score", "probability", "tier", "skill_count"),
        "market_alignment_score", "probability")


def alignment_scatter(spark, sf_dir):
    return _six(C.alignment_scatter(OrderWorld(spark, sf_dir).cohort), "market_alignment_score",
                "probability")


def unscored_cohort(spark, sf_dir):
    scored = C.score_cohort(OrderWorld(spark, sf_dir).features)
    return scored.groupBy("tier").agg(F.count("*").alias("students"),
                                      F.count("probability").alias("known"))


def tier_counts(spark, sf_dir):
    return C.tier_counts(OrderWorld(spark, sf_dir).cohort)


def cohort_kpis(spark, sf_dir):
    return _six(C.cohort_kpis(OrderWorld(spark, sf_dir).cohort), "mean_probability",
                "placement_rate")


def prob_histogram(spark, sf_dir):
    return C.probability_histogram(OrderWorld(spark, sf_dir).cohort)


def percentile(spark, sf_dir):
    scored = OrderWorld(spark, sf_dir).cohort.select("student_id", "probability")
    return _six(R.strict_percentile(scored, "probability", "percentile"), "probability",
                "percentile")


def price_percentile(spark, sf_dir):
    prices = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return _six(R.strict_percentile(prices, "o_totalprice", "percentile"), "percentile")


def cohort_medians(spark, sf_dir):
    cohort = OrderWorld(spark, sf_dir).cohort
    return _six(R.exact_medians(cohort, list(C.INDICATORS)), *C.INDICATORS)


def _sketched(spark, sf_dir, columns):
    """The cohort and its sketches, stored in three batches."""
    cohort, path = OrderWorld(spark, sf_dir).cohort, scratch_path(spark, "sketches")
    batch = F.pmod(F.crc32(F.col("student_id").cast("binary")), F.lit(3))
    for i in range(3):
        store_sketches(cohort.where(batch == i), columns, path, i)
    return cohort, merged_sketches(spark, path)


def sketch_medians(spark, sf_dir):
    """Medians from stored sketches; exact up to as many students as a sketch holds."""
    columns = list(C.INDICATORS)
    return _six(sketched_medians(_sketched(spark, sf_dir, columns)[1], columns), *columns)


def sketch_percentile(spark, sf_dir):
    cohort, merged = _sketched(spark, sf_dir, ["probability"])
    return _six(sketched_percentile(cohort, "probability", "percentile", merged).select("student_id", "percentile"),
                "percentile")


def student_deltas(spark, sf_dir):
    cohort = OrderWorld(spark, sf_dir).cohort
    deltas = C.deltas_to_median(cohort, R.exact_medians(cohort, list(C.INDICATORS)))
    names = [f"{c}_delta" for c in C.INDICATORS]
    return _six(deltas.select("student_id", *names), *names)


def common_gaps(spark, sf_dir):
    return C.common_gaps(OrderWorld(spark, sf_dir).gaps)


def intervention_list(spark, sf_dir):
    world = OrderWorld(spark, sf_dir)
    return _six(C.intervention_list(world.cohort, world.stored_gaps), "probability", "cgpa",
                "market_alignment_score")


# --- what-if -----------------------------------------------------------------

def scenarios(spark, sf_dir):
    world = OrderWorld(spark, sf_dir)
    plan = H.default_scenarios(world.stored_gaps).withColumn("internships_count", F.lit(3))
    return _six(_text(H.simulate(world.cohort, plan, world.market, frozen_scorer), "new_skills"),
                "new_alignment", "new_probability", "probability_gain", "alignment_gain")


def levers(spark, sf_dir):
    world = OrderWorld(spark, sf_dir)
    return _six(H.levers(world.cohort, world.stored_gaps, world.market, frozen_scorer), "gain")


def levers_long(spark, sf_dir):
    """The same levers, by the joins that serve larger markets."""
    world = OrderWorld(spark, sf_dir)
    return _six(H.levers(world.cohort, world.stored_gaps, world.market, frozen_scorer, inline=False), "gain")


def no_lever(spark, sf_dir):
    world = OrderWorld(spark, sf_dir)
    rows = H.levers(world.cohort, world.stored_gaps, world.market, frozen_scorer)
    return _six(H.without_lever(rows), "max_gain")


def student_view(spark, sf_dir):
    world = OrderWorld(spark, sf_dir)
    view = H.student_view(world.cohort, world.stored_gaps, world.market, world.taxonomy)
    table_text = F.transform("gap_table", lambda g: F.concat_ws(":", g["skill"], g["category"]))
    shown = view.withColumn("gap_table", table_text)
    lists = ("matched_skills", "missing_skills_ranked", "off_market_skills", "gap_table")
    numbers = ("probability", "percentile", "cgpa_delta", "market_alignment_score_delta")
    return _six(_text(shown, *lists).select("student_id", "tier", *numbers, *lists), *numbers)


# --- search ------------------------------------------------------------------

def _order_documents(spark, sf_dir):
    return S.search_documents(order_postings(spark, sf_dir))


def search_documents(spark, sf_dir):
    return _text(_order_documents(spark, sf_dir), "extracted_skills")


def search_index(spark, sf_dir):
    return S.posting_index(_order_documents(spark, sf_dir))


def stored_index_lookup(spark, sf_dir):
    """Index written sorted by skill, then a pushed-down lookup."""
    path = scratch_path(spark, "posting-index")
    S.write_index(S.posting_index(_order_documents(spark, sf_dir)), path)
    return S.search_by_skill(spark.read.parquet(path), "blue ring", size=5)


def index_report(spark, sf_dir):
    return S.index_report(_order_documents(spark, sf_dir))


def search_postings(spark, sf_dir):
    return _text(S.search_postings(_order_documents(spark, sf_dir), "hot gear"), "extracted_skills")


def postings_with_skill(spark, sf_dir):
    return _text(S.postings_with_skill(_order_documents(spark, sf_dir), "red plate"),
                 "extracted_skills")


def gap_postings(spark, sf_dir):
    world = OrderWorld(spark, sf_dir)
    return S.gap_postings(world.gaps, S.posting_index(_order_documents(spark, sf_dir)))


def gap_hits(spark, sf_dir):
    """The postings of a student's gaps in one row, out of a bucketed table."""
    world, name = OrderWorld(spark, sf_dir), f"hits_{uuid.uuid4().hex}"
    S.write_hits(S.posting_index(_order_documents(spark, sf_dir)), name, scratch_path(spark, name))
    found = S.gap_hits(world.gaps, spark.table(name))
    listed = F.transform("gaps", lambda g: F.concat_ws(":", g["gap_rank"].cast("string"), g["skill"], F.array_join(
        F.transform(g["hits"], lambda h: h["posting_id"]), ",")))
    return found.select("student_id", F.array_join(listed, ";").alias("gaps"))


# --- extraction quality ------------------------------------------------------

def _predicted_orders(spark, sf_dir):
    """Truth: all part names of an order; prediction: those not ``new``."""
    return order_postings(spark, sf_dir).withColumn("true_skills", F.col("extracted_skills")).withColumn(
        "extracted_skills", F.filter("extracted_skills", lambda s: ~s.startswith("new ")))


def extraction_quality(spark, sf_dir):
    return _six(X.extraction_quality(_predicted_orders(spark, sf_dir)).select(
        "posting_id", "n_found", "n_true", "n_both", "precision", "recall"), "precision", "recall")


def quality_summary(spark, sf_dir):
    return _six(X.quality_summary(_predicted_orders(spark, sf_dir)), "mean_precision",
                "mean_recall")


def text_quality(spark, sf_dir):
    """Part names found in the text of each order, against the parts it has."""
    world = OrderWorld(spark, sf_dir)
    found = X.extract_skills(order_texts(spark, sf_dir), world.taxonomy)
    return _six(X.extraction_quality(found).select(
        "posting_id", "n_found", "n_true", "n_both", "precision", "recall"), "precision", "recall")


def text_market(spark, sf_dir):
    """Demand of the full taxonomy over documents, conversations and web pages."""
    found = X.extract_skills(all_texts(spark, sf_dir), taxonomy_table(spark))
    return _six(D.with_category(D.market_demand(found), taxonomy_table(spark)), "pct_postings")


# --- sources -----------------------------------------------------------------

def external_postings(spark, sf_dir):
    raw = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("job_id"), F.col("source").alias("company_name"),
        F.col("lang").alias("title"), F.col("text").alias("description"))
    return normalise_postings(raw).drop("true_skills")


def external_students(spark, sf_dir):
    """The mark of a customer's balance, order and price class as a student file."""
    segment = F.col("c_mktsegment")
    raw = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("sl_no"),
        (F.col("c_custkey") % 60 + 40.0).alias("ssc_p"), (F.col("c_nationkey") + 50.0).alias("hsc_p"),
        (F.length(segment) * 7.0).alias("degree_p"),
        F.when(segment == "MACHINERY", "Sci&Tech").when(segment == "BUILDING", "Comm&Mgmt")
        .when(segment == "FURNITURE", "Arts").otherwise("Others").alias("degree_t"),
        F.when(F.col("c_nationkey") < 12, "Mkt&HR").otherwise("Mkt&Fin").alias("specialisation"),
        F.when(F.col("c_acctbal") > 0, "Yes").otherwise("No").alias("workex"),
        F.when(F.col("c_acctbal") > 4000, "Placed").otherwise("Not Placed").alias("status"))
    return _six(_text(normalise_students(raw), "skills"), "cgpa")


def csv_round_trip(spark, sf_dir):
    """Documents exported as CSV and read again, line breaks and quotes included."""
    path = scratch_path(spark, "postings-csv")
    export_csv(document_postings(spark, sf_dir), path)
    return postings_from_csv(spark, path, multi_line=True).select(
        "posting_id", "title", "company", F.md5("description").alias("description_md5"))


def students_csv(spark, sf_dir):
    """Students exported as CSV and read again with their types."""
    path = scratch_path(spark, "students-csv")
    export_csv(customer_students(spark, sf_dir), path)
    return _six(_text(students_from_csv(spark, path), "skills"), "cgpa")


def stage_tables(spark, sf_dir):
    """Rows of every table that the stages store."""
    def ingest():
        postings = document_postings(spark, sf_dir).select(
            F.format_string("JP%04d", "posting_id").alias("posting_id"), "title", "company",
            "description", F.lit(None).cast("array<string>").alias("true_skills"))
        return postings, customer_students(spark, sf_dir)
    base = scratch_path(spark, "stages")
    outcome = run_pipeline(spark, base, document_taxonomy(spark), ingest, retrain=False)
    if outcome.failed:
        raise outcome.error
    names = ("job_postings_skills", "market_skill_demand", "student_skill_gaps")
    return reduce(lambda a, b: a.unionByName(b), [spark.read.parquet(f"{base}/{n}").agg(
        F.lit(n).alias("stored"), F.count("*").alias("n_rows")) for n in names])


def intervention_csv(spark, sf_dir):
    """The intervention list as the downloadable file."""
    world, path = OrderWorld(spark, sf_dir), scratch_path(spark, "intervention-csv")
    export_csv(C.intervention_list(world.cohort, world.stored_gaps, ["At risk"]), path)
    return read_csv(spark, path, ["student_id", "tier", "top_gaps"])


def published_tables(spark, sf_dir):
    """Stored tables copied to another place; only those that exist."""
    base, target = scratch_path(spark, "tables"), scratch_path(spark, "export")
    world = OrderWorld(spark, sf_dir)
    write_table(world.market, f"{base}/market_skill_demand")
    write_table(world.gaps, f"{base}/student_skill_gaps")
    keys = publish(spark, base, "/latest/", target, PUBLISHED)
    counts = [spark.read.parquet(f"{target}/{key}").agg(
        F.lit(key).alias("key"), F.count("*").alias("n_rows")) for key in keys]
    return reduce(lambda a, b: a.unionByName(b), counts)


def student_lookup(spark, sf_dir):
    """One student out of the stored view."""
    path = scratch_path(spark, "cohort")
    write_table(OrderWorld(spark, sf_dir).cohort, path, ["student_id"])
    found = H.student(spark.read.parquet(path), "S0042")
    return _six(found.select("student_id", "tier", "probability", "skill_count"), "probability")


def uploaded_students(spark, sf_dir):
    """Uploads of both tables, then of the placed students alone, out of the store."""
    store = Snapshots(spark, scratch_path(spark, "store"))
    students, texts = customer_students(spark, sf_dir), order_texts(spark, sf_dir)
    posts, people, placed = (scratch_path(spark, n) for n in ("posts", "people", "placed"))
    export_csv(texts.select(F.lit("t").alias("title"), F.lit("c").alias("company"), "description"), posts)
    export_csv(students, people)
    export_csv(students.where("placed = 1"), placed)
    for files in ((posts, people), (None, placed)):
        errors = accept_uploads(spark, store, *files)
        if errors:
            raise ValueError(errors)
    return _six(_text(store.read("students"), "skills"), "cgpa")


def stored_tables(spark, sf_dir):
    """Rows of stored, absent and chosen tables, and which of them are ready."""
    base = scratch_path(spark, "base")
    paths, students = Paths(base), customer_students(spark, sf_dir)
    files = {n: f"{base}/{n}" for n in ("both", "one", "none")}
    for name in ("both", "one"):
        write_table(students.where("placed = 1"), files[name])

    def chosen(*names):
        return choose_source(spark, [files[n] for n in names], lambda: spark.read.parquet(files["one"]),
                             lambda: students, "parquet")

    before = pipeline_ready(spark, paths)
    for name in REQUIRED:
        replace_table(students, getattr(paths, name))
        replace_table(read_table(spark, getattr(paths, name)).where("projects_count > 0"), getattr(paths, name))
    rows = {"absent": read_table(spark, f"{base}/absent", STUDENTS), "replaced": read_table(spark, paths.students),
            "chosen_external": chosen("both", "one"), "chosen_generated": chosen("one", "none")}
    ready = {"absent": before, "replaced": pipeline_ready(spark, paths), "chosen_external": may_retrain(students),
             "chosen_generated": may_retrain(students.withColumn("placed", F.nullif("projects_count", F.lit(0))))}
    return reduce(lambda a, b: a.unionByName(b), [
        df.agg(F.lit(k).alias("case"), F.count("*").alias("n_rows"), F.lit(ready[k]).alias("ready"))
        for k, df in rows.items()])


# --- validation --------------------------------------------------------------

def _upload(spark, sf_dir):
    """Events as an uploaded student file with some unusable cells."""
    k = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("student_id"),
        F.col("value").cast("string").alias(" cgpa "),
        F.when(F.col("event_type") == "error", "n/a").otherwise(k).alias("projects_count"),
        F.col("event_type").alias("certifications_count"), k.alias("internships_count"),
        F.col("event_type").alias("skills"))


def validation_report(spark, sf_dir):
    df = V.trimmed_names(_upload(spark, sf_dir))
    return V.violations(df, STUDENT_NUMERIC, "skills", "student_id")


def numeric_coercion(spark, sf_dir):
    from ..functions.numbers import number_or_null
    df = V.trimmed_names(_upload(spark, sf_dir))
    long = df.select("student_id", *STUDENT_NUMERIC).unpivot(
        "student_id", list(STUDENT_NUMERIC), "column_name", "cell")
    return _six(long.withColumn("number", number_or_null(F.col("cell")))
                .groupBy("column_name").agg(F.count("number").alias("n_numbers"),
                                            F.coalesce(F.sum("number"), F.lit(0.0)).alias("total")),
                "total")


def dup_ids(spark, sf_dir):
    return V.duplicate_ids(V.trimmed_names(_upload(spark, sf_dir)), "student_id")


def seq_ids(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return R.sequential_ids(orders, "row_id", "S", ["o_orderdate", "o_orderkey"]).select(
        "row_id", "o_orderkey")


def prepared_postings(spark, sf_dir):
    """A posting upload without ids, checked and numbered in file order."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("lang").alias("title"), F.col("source").alias("company"),
        F.col("text").alias("description"))
    checked = V.validate_and_prepare(docs, ("title", "company", "description"), "posting_id", "JP")
    return checked.prepared.select("posting_id", "doc_id", "title", "company")


def random_sample(spark, sf_dir):
    return R.hash_sample(table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("item")),
        20_000, "item")


# --- model -------------------------------------------------------------------

def _judged_documents(spark, sf_dir):
    """Document quality against a fixed score with ties."""
    scores = table(spark, sf_dir, "documents").select("doc_id", (
        F.lit(1.0) / (F.lit(1.0) + F.exp(F.floor(F.col("n_chars") / 200) * 0.2 - 2.0)))
        .alias("probability"))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("placed"))
    return labels.join(scores, "doc_id")


def auc_exact(spark, sf_dir):
    return _six(P.auc(_judged_documents(spark, sf_dir)), "auc")


def accuracy(spark, sf_dir):
    return _six(P.accuracy(P.confusion(_judged_documents(spark, sf_dir))), "accuracy")


def class_report(spark, sf_dir):
    report = P.class_report(P.confusion(_judged_documents(spark, sf_dir)))
    return _six(report, "precision", "recall", "f1")


def class_guard(spark, sf_dir):
    """Whether training accepts all students, those of one outcome, and a few."""
    students = customer_students(spark, sf_dir).select("student_id", "placed")
    cases = {"all": students, "one_outcome": students.where("placed = 1"),
             "few": students.where("placed = 0").union(students.where("placed = 1").orderBy("student_id").limit(3))}
    return spark.createDataFrame([(k, P.trainable(v)) for k, v in cases.items()], "case string, accepted boolean")


def _scaled(spark, sf_dir):
    rows = P.complete_rows(OrderWorld(spark, sf_dir).features)
    training = durable(P.split(rows)).where(~F.col("is_test"))
    n = training.count()
    return training, n, Pipeline(stages=P.feature_stages(n)).fit(training)


def scaler_stats(spark, sf_dir):
    _, _, scaling = _scaled(spark, sf_dir)
    return _six(P.scaler_table(spark, scaling), "mean", "deviation")


def logistic_optimum(spark, sf_dir):
    """The gradient at the fitted weights over all training rows; 0 at the optimum."""
    training, n, scaling = _scaled(spark, sf_dir)
    found = P.logistic_gradient(training, scaling, P.logistic_learner(n))
    return found.withColumn("gradient", F.round("gradient", 3) + F.lit(0.0))


def stored_model_optimum(spark, sf_dir):
    """The gradient at the weights of a model that was stored and loaded again."""
    training, n, scaling = _scaled(spark, sf_dir)
    path, learner = scratch_path(spark, "model"), P.logistic_learner(n)
    model = learner.fit(scaling.transform(training).select("features", "placed"))
    P.save_model(PipelineModel(stages=[*scaling.stages, model]), path)
    found = P.gradient(training, P.load_model(spark, path), learner.getRegParam())
    return found.withColumn("gradient", F.round("gradient", 3) + F.lit(0.0))


def placement_rate(spark, sf_dir):
    return _six(C.placement_rate(customer_students(spark, sf_dir)), "placement_rate")


def train_split(spark, sf_dir):
    rows = customer_students(spark, sf_dir).select("student_id", "placed")
    return P.split(rows).select("student_id", "placed", "is_test")


def model_choice(spark, sf_dir):
    """Two fixed scorers judged on the labelled documents, one row per model and measure."""
    steps = F.floor(F.col("n_chars") / 200) * 0.2 - 2.0
    held_out = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("placed")).join(
        table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    best, results = P.judged(held_out, {
        "long_texts": lambda df: df.withColumn("probability", 1.0 / (1.0 + F.exp(-steps))),
        "short_texts": lambda df: df.withColumn("probability", 1.0 / (1.0 + F.exp(steps)))})
    metrics, path = P.metrics_table(spark, P.Trained(best, None, results)), scratch_path(spark, "metrics")
    write_metrics(metrics, path)
    long = P.metrics_long(spark.read.schema(metrics.schema).json(path))
    return _six(long, "value").withColumn("selected", F.col("model") == best)


def importance_order(spark, sf_dir):
    """Means of the training rows as weights of a model, by size."""
    training = _scaled(spark, sf_dir)[0]
    means = training.agg(*[F.round(F.avg(f), 6).alias(f) for f in FEATURES]).first().asDict()
    shown = P.importance_table(spark, P.Trained("means", None, importances={f: 1.0 - m for f, m in means.items()}))
    return _six(shown.withColumn("place", F.row_number().over(W.orderBy("size", "feature"))), "weight", "size")


def boosted_stump(spark, sf_dir):
    """The first split of the boosted trees over all training rows."""
    training = _scaled(spark, sf_dir)[0]
    tree = fit_boosted(training, FEATURES, rounds=1, depth=1).grown()
    rows = [(FEATURES[t["feature"][0]], t["threshold"][0], *t["value"], t["gain"][0]) for t in tree]
    return _six(spark.createDataFrame(rows, "feature string, threshold double, below double, above double, gain double"),
                "threshold", "below", "above", "gain")


def train_best(spark, sf_dir):
    """Both candidates fitted; one row per model and measure."""
    trained = P.train(OrderWorld(spark, sf_dir).features)
    long = P.metrics_long(P.metrics_table(spark, trained))
    return long.withColumn("selected", F.col("model") == trained.best)


QUERIES = {f.__name__: f for f in (
    skill_mentions, mentions_by_join, posting_skills, market_demand, demand_by_role, market_kpis, messages_json,
    process_messages, stream_extract, stream_until_idle, nan_messages, stream_demand, stream_demand_by_role, split_text_cells, market_demand_ranked, top_skills,
    scaled_demand, demand_rollup, demand_with_category, skill_gaps, skill_gaps_long, category_coverage_long, alignment, off_market, gap_detail,
    category_coverage, cohort_coverage, feature_frame, score_cohort, alignment_scatter,
    unscored_cohort, tier_counts, cohort_kpis, prob_histogram, percentile, price_percentile,
    cohort_medians, sketch_medians, sketch_percentile, student_deltas, common_gaps, intervention_list, scenarios, levers, levers_long, no_lever,
    student_view, search_documents, search_index, stored_index_lookup, index_report,
    search_postings, postings_with_skill,
    gap_postings, gap_hits, extraction_quality, quality_summary, text_quality,
    text_market, external_postings, external_students, csv_round_trip, students_csv, stage_tables,
    intervention_csv, published_tables, uploaded_students, stored_tables, student_lookup, validation_report,
    numeric_coercion, dup_ids, seq_ids, prepared_postings, random_sample, auc_exact, accuracy,
    class_report, class_guard, scaler_stats, logistic_optimum, stored_model_optimum, placement_rate, train_split, model_choice, importance_order,
    boosted_stump, train_best)}
