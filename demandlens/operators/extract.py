"""Skills found in free text.

Rules: a skill matches as a sequence of tokens, without regard to case unless
it is marked case-sensitive; of overlapping matches the longest wins, then the
earliest; a posting names a skill once, in the order of first mention.

With a vocabulary of ordinary size the whole step stays inside the row: there
is no shuffle, every posting gives one row, and the same columns run on a
stream. A vocabulary beyond ``INLINE_PHRASES`` goes through a join instead.
"""

from dataclasses import dataclass, field

from pyspark.sql import functions as F

from ..fixed_values import OTHER_CATEGORY
from ..functions.lists import or_empty
from ..functions.lookup import lookup
from ..functions.sizing import fetch_small
from ..functions.text import phrase_key, tokens
from .sieve import bitmap, sieved, token_hashes

INLINE_PHRASES = 4096

_SPAN = "struct<start:int,end:int,n:int,key:string,raw:string>"


@dataclass
class Phrases:
    """A vocabulary small enough to be part of the plan."""

    folded: list = field(default_factory=list)  # lower-case keys
    exact: list = field(default_factory=list)   # keys with their case
    names: dict = field(default_factory=dict)   # lower-case key -> skill, category

    @property
    def first_tokens(self):
        """Phrase lengths -> the first tokens that start phrases of exactly
        these lengths."""
        lengths = {}
        for key in self.folded + self.exact:
            words = key.lower().split(" ")
            lengths.setdefault(words[0], set()).add(len(words))
        groups = {}
        for word, sizes in sorted(lengths.items()):
            groups.setdefault(tuple(sorted(sizes)), []).append(word)
        return groups

    @property
    def reach(self):
        """Most matches that can start within the longest phrase."""
        lengths = {n for sizes in self.first_tokens for n in sizes}
        return max(lengths) * len(lengths)


def phrase_table(taxonomy):
    """Taxonomy plus the phrase key and its number of tokens."""
    keyed = taxonomy.withColumn("phrase", phrase_key(F.col("skill")))
    return (keyed.where(F.col("phrase") != "")
            .withColumn("key", F.lower("phrase"))
            .withColumn("n", F.size(F.split("phrase", " "))))


def small_phrases(taxonomy, limit=INLINE_PHRASES):
    """``Phrases`` if the taxonomy has at most ``limit`` entries, else ``None``."""
    rows = fetch_small(phrase_table(taxonomy), limit)
    if rows is None:
        return None
    found = Phrases()
    for row in sorted(rows, key=lambda r: (r["category_pos"], r["skill_pos"])):
        if row["case_sensitive"]:
            found.exact.append(row["phrase"])
        else:
            found.folded.append(row["key"])
        found.names[row["key"]] = {"skill": row["skill"],
                                   "category": row["category"] or OTHER_CATEGORY}
    return found


def _spans_in_row(toks, phrases):
    """Every match of the vocabulary in a token list, by start and length."""
    words = [w for group in phrases.first_tokens.values() for w in group]
    starts = F.array_compact(F.transform(
        toks, lambda t, i: F.when(F.lower(t).isin(words), i)))

    def lengths(token):
        cases = F
        for sizes, group in phrases.first_tokens.items():
            cases = cases.when(F.lower(token).isin(group), F.array(*[F.lit(n) for n in sizes]))
        return cases

    def grams(start):
        return F.transform(lengths(F.get(toks, start)), lambda n: F.struct(
            start.alias("start"), (start + n).alias("end"), n.alias("n"),
            F.array_join(F.slice(toks, start + 1, n), " ").alias("raw")))

    def known(gram):
        fits = gram["end"] <= F.size(toks)
        folded = F.lower(gram["raw"]).isin(phrases.folded) if phrases.folded else F.lit(False)
        exact = gram["raw"].isin(phrases.exact) if phrases.exact else F.lit(False)
        return fits & (folded | exact)

    hits = F.filter(F.flatten(F.transform(starts, grams)), known)
    return F.transform(hits, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["n"].alias("n"),
        F.lower(s["raw"]).alias("key"), s["raw"].alias("raw")))


def _bind(value, body):
    """``body`` over a value that is computed once per row.

    A plain expression used inside a lambda would be evaluated again for every
    element.
    """
    return F.get(F.transform(F.array(value), body), 0)


def _clusters(spans, reach):
    """Split spans (by start) into runs that do not touch each other.

    A run starts where no earlier span reaches into the current one; only spans
    that start within the longest phrase can, and there are at most ``reach``.
    """
    opens = F.array_compact(F.transform(spans, lambda s, i: F.when(
        ~F.exists(F.slice(spans, F.greatest(i - reach, F.lit(0)) + 1, F.least(i, F.lit(reach))),
                  lambda p: p["end"] > s["start"]), i + 1)))
    return _bind(opens, lambda at: F.transform(at, lambda first, k: F.slice(
        spans, first, F.coalesce(F.get(at, k + 1), F.size(spans) + 1) - first)))


def _longest_first(cluster):
    """Keep the longest, then earliest spans that do not overlap."""
    ranked = F.sort_array(F.transform(cluster, lambda s: F.struct(
        (-s["n"]).alias("rank"), s["start"].alias("start"), s["end"].alias("end"),
        s["n"].alias("n"), s["key"].alias("key"), s["raw"].alias("raw"))))
    spans = F.transform(ranked, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["n"].alias("n"),
        s["key"].alias("key"), s["raw"].alias("raw")))
    return F.aggregate(
        spans, F.array().cast(f"array<{_SPAN}>"),
        lambda kept, s: F.when(
            F.exists(kept, lambda k: (k["start"] < s["end"]) & (s["start"] < k["end"])), kept
        ).otherwise(F.concat(kept, F.array(s))))


def _first_mentions(spans):
    """One entry per key with its first position, by position."""
    by_key = F.sort_array(F.transform(spans, lambda s: F.struct(
        s["key"].alias("key"), s["start"].alias("first_pos"))))
    first = _bind(by_key, lambda m: F.filter(
        m, lambda x, i: (i == 0) | (F.get(m, i - 1)["key"] != x["key"])))
    return F.sort_array(F.transform(first, lambda m: F.struct(
        m["first_pos"].alias("first_pos"), m["key"].alias("key"))))


def _resolve(spans, reach):
    """Overlaps resolved: clusters of one span pass, others are folded."""
    return F.when(F.size(spans) <= 1, spans).otherwise(F.flatten(F.transform(
        _clusters(spans, reach),
        lambda c: F.when(F.size(c) == 1, c).otherwise(_longest_first(c)))))


def mentions_in_row(text, phrases):
    """Array of (first_pos, key), one per skill, in order of first mention."""
    if not phrases.names:
        return F.array().cast("array<struct<first_pos:int,key:string>>")
    return _bind(tokens(text), lambda toks: _bind(
        _spans_in_row(toks, phrases), lambda spans: _bind(
            _resolve(spans, phrases.reach), _first_mentions)))


def extract_skills(postings, taxonomy, text="description"):
    """One output row per posting with ``mentions``, ``extracted_skills`` and
    ``skill_categories``; postings without any skill keep empty lists."""
    phrases = small_phrases(taxonomy)
    if phrases is None:
        return _extract_by_join(postings, taxonomy, text)
    name_of = lookup(phrases.names, "struct<skill:string,category:string>")
    keyed = F.transform(mentions_in_row(F.col(text), phrases), lambda m: F.struct(
        m["first_pos"].alias("first_pos"), name_of(m["key"]).alias("name")))
    return _with_lists(postings.withColumn("mentions", F.transform(keyed, lambda m: F.struct(
        m["first_pos"].alias("first_pos"), m["name"]["skill"].alias("skill"),
        m["name"]["category"].alias("category")))))


def _with_lists(df):
    return (df.withColumn("extracted_skills", F.transform("mentions", lambda m: m["skill"]))
            .withColumn("skill_categories", F.sort_array(F.array_distinct(
                F.transform("mentions", lambda m: m["category"])))))


def candidates(postings, taxonomy, text):
    """(_digest, start, end, n, raw) of the token runs of each text that may be a phrase: all
    that are one, and at most one in sixteen of the others while the bitmap has its full size."""
    bits, lengths = bitmap(phrase_table(taxonomy), "phrase")
    hashed = postings.select(F.md5(text).alias("_digest"), F.col(text).alias("_text"),
                             token_hashes(F.col(text)).alias("_hashes"))
    spans = sieved(hashed, "_hashes", "_spans", bits, lengths)
    grams = _bind(tokens(F.col("_text")), lambda toks: F.transform("_spans", lambda s: F.struct(
        s["start"].alias("start"), (s["start"] + s["n"]).alias("end"), s["n"].alias("n"),
        F.array_join(F.slice(toks, s["start"] + 1, s["n"]), " ").alias("raw"))))
    return spans.select("_digest", F.inline_outer(grams))


def _extract_by_join(postings, taxonomy, text):
    """The same result for a vocabulary too large for the plan.

    Token runs that pass a bitmap of the vocabulary meet the phrase table in one equi-join;
    Spark chooses the strategy. So what is shuffled is in proportion to the matches, not to
    the texts. Matched spans are grouped by a digest of their text, so copies of
    a text, however many, fall together before the shuffle, and a group is
    never larger than one text. Ids need not be unique.
    """
    table = phrase_table(taxonomy)
    lengths = [r["n"] for r in table.select("n").distinct().collect()]
    names = (table.withColumn("at", F.struct("category_pos", "skill_pos"))
             .groupBy("key").agg(
                 F.max_by(F.struct("skill", F.coalesce("category", F.lit(OTHER_CATEGORY))
                                   .alias("category")), "at").alias("name"),
                 F.max(~F.col("case_sensitive")).alias("any_case"),
                 F.collect_set(F.when(F.col("case_sensitive"), F.col("phrase"))).alias("exact")))

    hits = (candidates(postings, taxonomy, text)
            .withColumn("key", F.lower("raw")).join(names, "key")
            .where(F.col("any_case") | F.array_contains("exact", F.col("raw"))))
    reach = max(lengths, default=1) * max(len(lengths), 1)
    found = hits.groupBy("_digest").agg(
        F.sort_array(F.collect_set(F.struct("start", "end", "n", "key", "raw"))).alias("spans"),
        F.map_from_entries(F.collect_set(F.struct("key", "name"))).alias("names"))
    mentions = F.transform(
        _bind(F.col("spans"), lambda s: _bind(_resolve(s, reach), _first_mentions)),
        lambda m: F.struct(m["first_pos"].alias("first_pos"),
                           F.element_at("names", m["key"])["skill"].alias("skill"),
                           F.element_at("names", m["key"])["category"].alias("category")))
    empty = F.array().cast("array<struct<first_pos:int,skill:string,category:string>>")
    keyed = postings.withColumn("_digest", F.md5(text))
    return _with_lists(keyed.join(found.select("_digest", mentions.alias("mentions")), "_digest", "left")
                       .withColumn("mentions", F.coalesce("mentions", empty)).drop("_digest"))


def job_skills(extracted, id_col="posting_id"):
    """Long form: one row per posting and skill."""
    # inline_outer: plain inline makes the optimizer repeat the whole extraction
    # in a "not empty" filter below it.
    spread = extracted.select(F.col(id_col), F.inline_outer("mentions"))
    return spread.where(F.col("skill").isNotNull()).select(
        id_col, "skill", "category", "first_pos")


def _quality(df, predicted, truth):
    found, real = or_empty(predicted), or_empty(truth)
    sized = df.withColumns({"n_found": F.size(F.array_distinct(found)),
                            "n_true": F.size(F.array_distinct(real)),
                            "n_both": F.size(F.array_intersect(found, real))})
    share = lambda whole: F.when(F.col(whole) > 0, F.col("n_both") / F.col(whole)).otherwise(0.0)
    return sized.withColumns({"precision": share("n_found"), "recall": share("n_true")})


def extraction_quality(df, predicted="extracted_skills", truth="true_skills"):
    """Per row: precision and recall of the distinct skills, 0 if a side is
    empty; rows where both are empty are left out."""
    return _quality(df, predicted, truth).where(F.col("n_found") + F.col("n_true") > 0)


def quality_summary(df, predicted="extracted_skills", truth="true_skills"):
    """Means over the rows; no row at all when no posting is labelled.

    Rows that do not count are skipped inside the means: a filter on the lists
    would be moved below the extraction and run it twice.
    """
    counts = F.col("n_found") + F.col("n_true") > 0
    return _quality(df, predicted, truth).agg(
        F.avg(F.when(counts, F.col("precision"))).alias("mean_precision"),
        F.avg(F.when(counts, F.col("recall"))).alias("mean_recall"),
        F.count_if(counts).alias("n_rows"), F.count(truth).alias("_labelled"),
    ).where((F.col("n_rows") > 0) & (F.col("_labelled") > 0)).drop("_labelled")
