"""Ingest, extract, features, train: one stored table per stage.

With ``resume`` a run leaves out the stages that an earlier one finished. Each finished stage
has a small manifest beside the tables: a digest of what it was made from (files and
parameters) and of the files it left. A stage is done if both are still the same.
"""

import hashlib
import json
from dataclasses import dataclass, field

from pyspark.sql import functions as F

from ..operators.cohort import feature_frame, score_cohort
from ..operators.demand import market_demand
from ..operators.extract import extract_skills
from ..operators.gaps import skill_gaps
from ..operators.placement import metrics_table, model_scorer, save_model, train
from ..operators.search import posting_index, search_documents, write_index
from ..operators.validate import may_retrain
from ..sinks.tables import write_metrics, write_table
from ..sources.tables import ready


@dataclass(frozen=True)
class Paths:
    base: str

    def __getattr__(self, name):
        if name.startswith("_"):
            raise AttributeError(name)
        return f"{self.base}/{name}"


REQUIRED = ("students", "student_skill_gaps", "market_skill_demand")


def pipeline_ready(spark, paths):
    return ready(spark, [getattr(paths, name) for name in REQUIRED])


def extract_stage(spark, paths, taxonomy):
    found = extract_skills(spark.read.parquet(paths.postings), taxonomy)
    write_table(found.drop("mentions"), paths.job_postings_skills)


def features_stage(spark, paths):
    write_table(market_demand(spark.read.parquet(paths.job_postings_skills)),
                paths.market_skill_demand)
    gaps = skill_gaps(spark.read.parquet(paths.students), spark.read.parquet(paths.market_skill_demand))
    write_table(gaps, paths.student_skill_gaps, ["student_id"])


def index_stage(spark, paths):
    documents = search_documents(spark.read.parquet(paths.job_postings_skills))
    write_index(posting_index(documents), paths.posting_index)


def train_stage(spark, paths, rounds=200):
    features = feature_frame(spark.read.parquet(paths.students),
                             spark.read.parquet(paths.student_skill_gaps))
    trained = train(features, rounds=rounds)
    save_model(trained.model, paths.placement_model)
    write_metrics(metrics_table(spark, trained), paths.model_metrics)
    write_table(score_cohort(features, model_scorer(trained.model)), paths.placement_scores, ["student_id"])


class Manifests:
    """What each stage of a base folder was made from, and what it left."""

    def __init__(self, spark, base):
        self.spark, self.base = spark, base
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _path(self, name):
        path = self._jvm.org.apache.hadoop.fs.Path(f"{self.base}/_stages/{name}.json")
        return path, path.getFileSystem(self._conf)

    def digest(self, paths, parameters=None):
        """Of the names, sizes and times of all files below the paths, and of parameters."""
        found = []
        for name in paths:
            path = self._jvm.org.apache.hadoop.fs.Path(name)
            files = path.getFileSystem(self._conf)
            if not files.exists(path):
                found.append([name, None, None])
                continue
            every = files.listFiles(path, True)
            while every.hasNext():
                status = every.next()
                found.append([status.getPath().toString(), status.getLen(), status.getModificationTime()])
        return hashlib.sha256(json.dumps([sorted(found, key=str), parameters], sort_keys=True).encode()).hexdigest()

    def finished(self, name, inputs, outputs, parameters):
        path, files = self._path(name)
        if not files.exists(path):
            return False
        stream = files.open(path)
        try:
            known = json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return known == {"made_from": self.digest(inputs, parameters), "left": self.digest(outputs)}

    def finish(self, name, made_from, outputs):
        path, files = self._path(name)
        out = files.create(path, True)
        out.write(json.dumps({"made_from": made_from, "left": self.digest(outputs)}).encode())
        out.close()


def table_mark(df):
    """A number that changes with the rows of a small table."""
    return str(df.agg(F.count("*"), F.bit_xor(F.xxhash64(*df.columns))).first())


@dataclass
class Outcome:
    finished: list
    failed: str | None = None
    error: Exception | None = None
    skipped: list = field(default_factory=list)


def run_stages(stages, manifests=None):
    """Run (name, callable) pairs in order; stop at the first failure and name
    its stage. With ``manifests`` the pairs are (name, callable, inputs, outputs, parameters),
    finished stages are left out and finished ones noted."""
    finished, skipped = [], []
    for name, step, *about in stages:
        try:
            if manifests:
                inputs, outputs, parameters = about
                if manifests.finished(name, inputs, outputs, parameters):
                    skipped.append(name)
                    continue
                made_from = manifests.digest(inputs, parameters)
            step()
            if manifests:
                manifests.finish(name, made_from, outputs)
        except Exception as error:  # reported, not raised: the caller shows the stage
            return Outcome(finished, name, error, skipped)
        finished.append(name)
    return Outcome(finished, skipped=skipped)


def run_pipeline(spark, base, taxonomy, ingest=None, retrain=None, rounds=200, resume=False, source="1"):
    """``ingest`` returns (postings, students) to store first. Training runs if
    asked for or, by default, if every outcome is known. With ``resume`` finished stages are
    not run again; ``source`` names the data that ``ingest`` reads, so that another name has it
    read anew."""
    paths = Paths(base)

    def store():
        postings, students = ingest()
        write_table(postings, paths.postings)
        write_table(students, paths.students, ["student_id"])

    def maybe_train():
        wanted = may_retrain(spark.read.parquet(paths.students)) if retrain is None else retrain
        if wanted:
            train_stage(spark, paths, rounds)

    if not resume:
        stages = [("ingest", store)] if ingest else []
        stages += [("extract", lambda: extract_stage(spark, paths, taxonomy)),
                   ("features", lambda: features_stage(spark, paths)),
                   ("index", lambda: index_stage(spark, paths)),
                   ("train", maybe_train)]
        return run_stages(stages)
    tables = [paths.postings, paths.students]
    stages = [("ingest", store, [], tables, source)] if ingest else []
    stages += [("extract", lambda: extract_stage(spark, paths, taxonomy), [paths.postings], [paths.job_postings_skills],
                table_mark(taxonomy)),
               ("features", lambda: features_stage(spark, paths), [paths.job_postings_skills, paths.students],
                [paths.market_skill_demand, paths.student_skill_gaps], None),
               ("index", lambda: index_stage(spark, paths), [paths.job_postings_skills], [paths.posting_index], None),
               ("train", maybe_train, [paths.students, paths.student_skill_gaps],
                [paths.placement_model, paths.model_metrics, paths.placement_scores], [retrain, rounds])]
    return run_stages(stages, Manifests(spark, base))
