"""The corpus pipeline: STAGES over ``documents``, each written and read again.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the
columns of documents; ``n_chars`` is passed on as it was given. The last adds piece ids.
"""

from demandlens.llm import centroids, hyperminhash, line_runs, pieces, suffix_arrays
from demandlens.session import scratch_path

ORACLE_SQL = None


def language_id(spark, docs, sf_dir):
    """Documents whose language can be told; the others go. The model is learned from the
    labelled documents among those given."""
    found = centroids.identify(docs, centroids.train(docs), names=("_lang", "_score", "_accepted"))
    return found.where("_accepted").select(*docs.columns)


def line_dedup(spark, docs, sf_dir):
    """Texts without the lines that three or more documents share, but in the last of them."""
    return line_runs.dedup_lines(docs, counts=("_lines", "_dropped")).select(*docs.columns)


def near_dedup(spark, docs, sf_dir):
    """One document of each group of near duplicates: the one with the smallest id."""
    return hyperminhash.deduplicate(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that hold no window of the benchmark."""
    return suffix_arrays.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece(spark, docs, sf_dir):
    """Piece ids of each text, with parity and round trip."""
    return pieces.encode(docs).select("doc_id", "ids", "n_tokens", "parity", "round_trip")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]


def run(spark, sf_dir):
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
