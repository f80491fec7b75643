"""The given tables read as postings, students and a taxonomy.

* documents: a posting per document (text, language as title, source as
  company);
* orders: a posting per order, its skills are the part names it contains;
* customers: a student per customer, with the part names returned by them as
  skills and their order counts as indicators.
"""

from functools import cached_property

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.sizing import fetch_small
from ..operators.cohort import feature_frame, score_cohort
from ..operators.demand import DemandProfile, count_skills
from ..operators.gaps import skill_gaps
from ..operators.placement import linear_scorer
from ..operators.ranking import running_total
from ..session import durable
from ..taxonomy import taxonomy_table

# Phrases that occur in the documents; some are nested, two are case-sensitive.
DOCUMENT_TAXONOMY = {
    "Licences": ["License", "Apache", "Apache License", "MIT License",
                 "GNU General Public License", "All Rights Reserved"],
    "Function words": ["the", "of the", "in the", "as the", "to be", "In", "R"],
}
DOCUMENT_EXACT = ("In", "R")

# A frozen scorer, so that scored results can be checked in plain SQL.
INTERCEPT = -3.4
WEIGHTS = {"cgpa": 0.25, "projects_count": 0.05, "certifications_count": 0.1,
           "internships_count": 0.2, "skill_count": 0.05, "market_alignment_score": 2.0}
frozen_scorer = linear_scorer(INTERCEPT, WEIGHTS)

URGENT, HIGH_PRICE = "1-URGENT", 450000.0
FEW_FILES = 16


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df):
    """Rows of a table of very few files, dealt out to all cores before costly
    work on each row: one file with one row group is one task. Tables of many
    files are read as they lie, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    few = len(df.inputFiles()) < min(FEW_FILES, cores)
    return df.repartition(cores) if few else df


def document_postings(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("posting_id"), F.col("lang").alias("title"),
        F.col("source").alias("company"), F.col("text").alias("description"))
    return spread(docs)


def document_taxonomy(spark):
    return taxonomy_table(spark, DOCUMENT_TAXONOMY, DOCUMENT_EXACT)


def order_skills(spark, sf_dir):
    """Long form: one row per order and part name."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return (items.join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .select("l_orderkey", F.col("p_name").alias("skill")).distinct())


def order_postings(spark, sf_dir):
    """One row per order; orders without items keep an empty list."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    lists = (items.join(parts, F.col("l_partkey") == F.col("p_partkey")).groupBy("l_orderkey")
             .agg(F.sort_array(F.collect_set("p_name")).alias("extracted_skills")))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return (orders.join(lists, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.format_string("JP%04d", "o_orderkey").alias("posting_id"),
        F.col("o_orderpriority").alias("title"), F.col("o_orderstatus").alias("company"),
        F.coalesce("extracted_skills", F.array().cast("array<string>")).alias("extracted_skills")))


def order_texts(spark, sf_dir):
    """A posting per order whose text names its parts, each followed by its type and kind
    again, so that some texts hold phrases of parts they do not have; ``true_skills`` are
    the names of the parts."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.concat_ws(
        " ", "p_name", "p_type", F.element_at(F.split("p_name", " "), -1)).alias("phrase"))
    return (items.join(parts, F.col("l_partkey") == F.col("p_partkey")).groupBy("l_orderkey").agg(
        F.array_join(F.sort_array(F.collect_set("phrase")), ", ").alias("description"),
        F.sort_array(F.collect_set("p_name")).alias("true_skills"))
        .select(F.format_string("JP%04d", "l_orderkey").alias("posting_id"), "description", "true_skills"))


def all_texts(spark, sf_dir):
    """Documents, conversation turns and web pages as postings."""
    def part(name, mark, text, *keys):
        return table(spark, sf_dir, name).select(
            F.concat(F.lit(mark), F.concat_ws("-", *keys)).alias("posting_id"), F.col(text).alias("description"))
    return spread(part("documents", "D", "text", "doc_id").union(part("conversations", "C", "text", "conv_id", "turn"))
                  .union(part("pages", "P", "html", "page_id")))


def order_market(spark, sf_dir):
    """Demand by part name; orders without items count as postings."""
    n = table(spark, sf_dir, "orders").agg(F.count("*").alias("n"))
    return count_skills(order_skills(spark, sf_dir), n)


def part_taxonomy(spark, sf_dir):
    """Part name -> its last word. The vocabulary, not the part table, is
    ranked."""
    names = (table(spark, sf_dir, "part").select(F.col("p_name").alias("skill")).distinct()
             .withColumn("category", F.element_at(F.split("skill", " "), -1)))
    places = running_total(names.select("category").distinct().withColumn("_one", F.lit(1)),
                           ["category"], "_one", "category_pos")
    return names.join(places, "category").select(
        "category", "skill", F.lit(False).alias("case_sensitive"), F.col("category_pos").cast("int"),
        (F.row_number().over(W.partitionBy("category").orderBy("skill")) - 1).alias("skill_pos"))


def customer_students(spark, sf_dir, skill_columns=("p_name",)):
    """One student per customer; the skills are the values of some part columns."""
    orders = table(spark, sf_dir, "orders")
    counts = orders.groupBy("o_custkey").agg(
        F.count("*").cast("int").alias("projects_count"),
        F.count_if(F.col("o_orderstatus") == "F").cast("int").alias("certifications_count"),
        F.count_if(F.col("o_orderpriority") == URGENT).cast("int").alias("internships_count"),
        F.max(F.when((F.col("o_orderpriority") == URGENT)
                     & (F.col("o_totalprice") > HIGH_PRICE), 1).otherwise(0)).alias("placed"))
    returned = (table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
                .select("l_orderkey", "l_partkey"))
    parts = table(spark, sf_dir, "part").select("p_partkey", F.explode(F.array(*skill_columns)).alias("skill"))
    owners = orders.select("o_orderkey", F.col("o_custkey").alias("s_custkey"))
    skills = (returned.join(parts, F.col("l_partkey") == F.col("p_partkey"))
              .join(owners, F.col("l_orderkey") == F.col("o_orderkey"))
              .groupBy("s_custkey").agg(F.sort_array(F.collect_set("skill")).alias("skills")))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    zero = F.lit(0)
    return (customers.join(counts, F.col("c_custkey") == F.col("o_custkey"), "left")
            .join(skills, F.col("c_custkey") == F.col("s_custkey"), "left").select(
        F.format_string("S%04d", "c_custkey").alias("student_id"),
        (F.col("c_acctbal") / 1000.0).alias("cgpa"),
        *[F.coalesce(c, zero).alias(c) for c in
          ("projects_count", "certifications_count", "internships_count")],
        F.coalesce("skills", F.array().cast("array<string>")).alias("skills"),
        F.coalesce("placed", zero).alias("placed")))


class OrderWorld:
    """Students, market, gaps and scored cohort of one data directory."""

    def __init__(self, spark, sf_dir):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def students(self):
        return customer_students(self.spark, self.sf_dir)

    @cached_property
    def stored_students(self):
        """For plans that read the students on several sides of a join."""
        return durable(self.students)

    @cached_property
    def _market(self):
        market = order_market(self.spark, self.sf_dir)
        profile = DemandProfile.load(market)
        if profile is None:
            return market, None
        # Within the checked size the computed rows stand in for the query.
        return self.spark.createDataFrame(profile.rows, market.schema), profile

    @property
    def market(self):
        return self._market[0]

    def gaps_of(self, students):
        return skill_gaps(students, self.market, profile=self._market[1])

    @property
    def gaps(self):
        return self.gaps_of(self.students)

    @property
    def stored_gaps(self):
        return self.gaps_of(self.stored_students)

    @cached_property
    def taxonomy(self):
        names = part_taxonomy(self.spark, self.sf_dir)
        rows = fetch_small(names)
        return names if rows is None else self.spark.createDataFrame(rows, names.schema)

    @property
    def features(self):
        return feature_frame(self.stored_students, self.stored_gaps)

    @property
    def cohort(self):
        return score_cohort(self.features, frozen_scorer)
