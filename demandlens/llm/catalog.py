"""Queries of this package over the given tables, and their SQL."""

from demandlens.llm import (alignment, cascade, centroids, disclosure, guess_cost, hash_tree, hidden_markov, hyperminhash,
                            kneser_ney, line_runs, pieces, suffix_arrays, whitening)
from demandlens.llm.frames import doc_bucket, table
from pyspark.sql import functions as F


def op1_lm_scoring(spark, sf_dir):
    """Log probability of every document under the hidden Markov model."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return hidden_markov.score(docs, doc_bucket("doc_id", 5) == 1).withColumnRenamed("doc", "doc_id")


def op2_language_id(spark, sf_dir):
    """The language of every document, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = doc_bucket("doc_id", 4) == 2
    model = centroids.train(docs.where(~held_out))
    found = centroids.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


def op3_pii(spark, sf_dir):
    """Personal data of every document: counts per base kind and all spans."""
    found = disclosure.find(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in (*disclosure.KINDS, "term")]
    base = F.filter("spans", lambda s: s["kind"] != "term")
    return found.select("doc_id", *counts[:-1], F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"), counts[-1])


def op4_secret_scans(spark, sf_dir):
    """Secrets of every document: counts per base pattern and all spans."""
    found = guess_cost.secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("secrets", lambda s: s["kind"] != "guess")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"),
                        count("guess"))


def op5_sentencepiece(spark, sf_dir):
    """Piece ids of every document, as number and digest, with parity and round trip."""
    found = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_tokens", F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                        "parity", "round_trip")


def op6_benchmark_decontamination(spark, sf_dir):
    """Words of each document inside occurrences of benchmark windows."""
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = suffix_arrays.hits(docs.select("doc_id", "text"), benchmark)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op7_line_dedup(spark, sf_dir):
    """Every document without its repeated lines."""
    kept = line_runs.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op8_quality_classifier(spark, sf_dir):
    """Perplexity of every document under the trusted texts' model, and the verdict."""
    found = kneser_ney.classify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"),
                                table(spark, sf_dir, "labels"))
    return found.withColumnRenamed("doc", "doc_id")


def op9_minhash_near_dedup(spark, sf_dir):
    """Components of documents that share four of five of their 4-word shingles."""
    found = hyperminhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), size=4)
    return found.select(F.col("doc").alias("doc_id"), "n_shingles",
                        F.col("component").alias("component_id"), "kept")


def op10_quality_rules(spark, sf_dir):
    """Counts and verdict of the quality rules for every document. The figures that are not
    returned are measured inside the chain, for the rows that no earlier rule rejects."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    shown = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    measures = cascade.measures(F.col("text"))
    counted, figure = cascade.measured(docs, "text", shown)
    order = cascade.ordered(docs, cascade.rules(measures))
    conditions = cascade.rules({**measures, **figure})
    base_failed = conditions["base_few_words"] | conditions["base_repeats"]
    return counted.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                          base_failed.alias("base_failed"),
                          (~base_failed & cascade.verdict(conditions, order).isNull()).alias("kept"))


def op11_embedding_whitening(spark, sf_dir):
    """Every sound embedding on the eight leading components, one row a component."""
    found = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    rows = found.select("*", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "value"))
    return rows.select(F.col("id").alias("vec_id"), (F.col("at") + 1).alias("component"), "n", "deviation",
                       F.col("value.whitened").alias("whitened"), F.col("value.explained").alias("explained"),
                       "identity_error")


def op12_sharding(spark, sf_dir):
    """The shard, slot and shard after growth of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = hash_tree.assigned(docs, hash_tree.production_tree(8), hash_tree.production_tree(9))
    return found.select(F.col("doc").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                        "grown_shard")


def op13_tokenizer_alignment(spark, sf_dir):
    """Groups and links of two tokenizers over every document, with corpus-wide counts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.align(docs).withColumnRenamed("doc", "doc_id")


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_language_id": op2_language_id,
    "op3_pii": op3_pii,
    "op4_secret_scans": op4_secret_scans,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_line_dedup": op7_line_dedup,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_sharding": op12_sharding,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}

ORACLE = {
    "op10_quality_rules": r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
grams AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
again AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM again) GROUP BY doc_id),
f AS (
  SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
         length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS n_letters,
         length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) AS n_capitals
  FROM w LEFT JOIN repeats USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 10 * word_chars OR (n_lines >= 4 AND 100 * n_dup_lines > 40 * n_lines)
            OR word_chars < 2 * n_words OR word_chars > 25 * n_words
            OR 100 * n_letters < 50 * word_chars OR 100 * n_capitals > 60 * n_letters) AS kept
FROM b""",
    "op6_benchmark_decontamination": r"""
WITH d AS (
  SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents)),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS size,
         array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
grams AS (
  SELECT doc_id, pos, size,
         array_to_string(list(w) OVER (PARTITION BY doc_id, size ORDER BY pos
                                       ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING)[1:size], ' ') AS win
  FROM d, sizes),
found AS (SELECT g.doc_id, g.pos, g.size, x.item_id FROM grams g JOIN windows x ON g.win = x.win AND g.size = x.size),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
    SELECT doc_id, unnest(range(pos, pos + size)) AS p FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::varchar AS item FROM found) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_words FROM d GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op7_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, line, pos,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE r.key IS NOT NULL AND doc_id <> last) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
              FILTER (WHERE r.key IS NULL OR doc_id = last), '')) AS kept_sha256
FROM keyed k LEFT JOIN repeated r ON k.key = r.key
GROUP BY doc_id""",
}
