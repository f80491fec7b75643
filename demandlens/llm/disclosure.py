"""Personal data in texts, and terms that give it away, in column expressions only.

Four fixed patterns find emails, addresses, cards and phone numbers. Around each find the
words of a window are its context. Over the whole corpus, a term discloses an entity to the
degree that meeting the term tells the entity: with p(e) the share of documents that hold
the entity and p(e|t) its share among the documents that hold the term,

    disclosure = log2(p(e|t) / p(e)) / -log2 p(e),

0 for an unrelated term, 1 for one that occurs with this entity alone. A term beyond the
threshold, with enough different contexts behind it, is marked wherever it occurs. Sanitised
text has finds replaced by their kind, terms generalised to a placeholder, and terms beyond
the second threshold removed.

Documents are counted whole: a term may stand anywhere in the documents of an entity. Terms
that too many documents hold to disclose any entity, and entities whose own number rules a
term out, are dropped before pairs are counted. The documents that hold a term are counted in
the tasks before anything is shuffled; where the disclosing terms lie, a table of at most ``BUCKETS`` hash values drops the
other words before they are shuffled.
"""

from demandlens.llm.frames import fresh, stored
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: The base patterns, written so that they cannot backtrack: each is anchored where a run
#: begins (or the last find ended) and takes whole runs.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a kind to be worth looking for.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
TERM, LONG_TERM = r"\p{L}+", r"\p{L}{4,}"
#: Words on each side of a find, taken from so many characters: those of any length, and as
#: many of four letters and more.
WIDTH, REACH = 6, 160
MIN_CONTEXTS = 3
GENERALISE, REMOVE = 0.75, 0.95
#: Hash values by which words are sorted out before they are shuffled: so many per term, within
#: bounds; the table that is broadcast has one row a term at most and never more than these.
PER_TERM, FEWEST, BUCKETS = 256, 1 << 16, 1 << 22
SPAN = "array<struct<kind:string,start:bigint,end:bigint>>"


def let(value, use):
    """``use`` of ``value``, which is evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def valid(kind, found):
    """Whether a find counts; finds that do not are dropped without another try."""
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(found, "\\."), lambda p: let(
            F.ltrim(p, F.lit("0")), lambda d: (F.length(d) < 3) | ((F.length(d) == 3) & (d <= "255"))))
    if kind == "card":
        def luhn(text):
            worth = F.transform(F.split(F.reverse(text), ""), lambda c, i: let(
                c.cast("int") * (1 + i % 2), lambda v: F.when(v > 9, v - 9).otherwise(v)))
            return F.aggregate(worth, F.lit(0), lambda a, v: a + v) % 10 == 0
        return let(digits, lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def pieces(text, pattern, hint):
    """struct(gaps, found): what lies between the finds of a pattern, and the finds."""
    empty = F.array().cast("array<string>")
    has = text.rlike(hint)
    return F.struct(F.when(has, F.split(text, pattern, -1)).otherwise(F.array(text)).alias("gaps"),
                    F.when(has, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(empty).alias("found"))


def placed(kind, gaps, found, keep):
    """The spans of all finds that ``keep`` takes, in code points."""
    empty = F.array().cast(SPAN)

    def add(state, both):
        start = state["at"] + F.length(both["gap"])
        end = start + F.length(both["find"])
        own = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(keep(both["find"]), F.concat(state["spans"], F.array(own)))
                        .otherwise(state["spans"]).alias("spans"))

    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found,
                       lambda g, f: F.struct(g.alias("gap"), f.alias("find")))
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("spans"))
    return F.when(F.size(found) == 0, empty).otherwise(
        F.aggregate(pairs, zero, lambda s, b: add(s, b).cast("struct<at:bigint,spans:" + SPAN + ">"), lambda s: s["spans"]))


def base_spans(text):
    """All base spans of a text, by kind as listed, then start; null has none."""
    text = F.coalesce(text, F.lit(""))

    def spans(kind):
        return let(pieces(text, PATTERNS[kind], HINTS[kind]),
                   lambda p: placed(kind, p["gaps"], p["found"], lambda f: valid(kind, f)))

    return F.concat(*[spans(k) for k in KINDS])


def contexts(docs, doc_id, text):
    """(doc, entity, words): one row per valid find, with the terms around it."""
    def around(kind):
        def windows(p):
            return F.transform(p["found"], lambda f, i: F.struct(
                F.concat(F.lit(f"{kind}:"), F.lower(f)).alias("entity"),
                valid(kind, f).alias("valid"),
                F.concat(*[side for term in (LONG_TERM, TERM) for side in (
                    let(F.regexp_extract_all(F.lower(F.right(p["gaps"][i], F.lit(REACH))), F.lit(term), F.lit(0)),
                        lambda w: F.slice(w, F.greatest(F.size(w) - (WIDTH - 1), F.lit(1)), F.lit(WIDTH))),
                    F.slice(F.regexp_extract_all(F.lower(F.left(p["gaps"][i + 1], F.lit(REACH))), F.lit(term), F.lit(0)),
                            F.lit(1), F.lit(WIDTH)))]).alias("words")))
        return let(pieces(F.coalesce(F.col(text), F.lit("")), PATTERNS[kind], HINTS[kind]), windows)

    some = F.coalesce(F.col(text).rlike("|".join(HINTS.values())), F.lit(False))
    found = docs.where(some).select(F.col(doc_id).alias("doc"), F.explode(F.concat(*[around(k) for k in KINDS])).alias("f"))
    return found.where("f.valid").select("doc", "f.entity", "f.words")


def disclosing_terms(docs, doc_id="doc_id", text="text", min_contexts=MIN_CONTEXTS, threshold=GENERALISE):
    """(term, disclosure): the terms that reveal some entity at least to ``threshold``, with
    the largest degree over all entities. ``None`` where no pair has enough contexts.

    Candidates are the terms in at least ``min_contexts`` different windows of the entity, and
    those anywhere in as many of its documents with different words, so copies of one text give
    no evidence. Either way p(e|t) is counted over whole documents. ``total`` and the documents
    that hold a term are counted by row, pairs by id.
    """
    found = stored(contexts(docs, doc_id, text), "contexts")
    total = docs.count()
    owners = stored(found.select("doc", "entity").distinct(), "owners")
    entities = stored(owners.groupBy("entity").agg(F.count("doc").alias("docs")).where(F.col("docs") < total), "entities")
    if entities.isEmpty():
        return None

    # With d documents of the entity, disclosure >= threshold asks for a term that at most
    # d ** threshold * total ** (1 - threshold) documents hold; rounding stays on the safe side.
    def most(d):
        return F.pow(d, F.lit(threshold)) * F.pow(F.lit(float(total)), F.lit(1 - threshold)) * (1 + 1e-9)

    limit = entities.agg(F.max(most(F.col("docs"))).alias("m")).first()["m"]
    # Every word is counted where it lies before the few candidates are picked.
    holders = words_in(docs.select(text), text).groupBy("term").agg(F.count("*").alias("holders"))
    holders = stored(holders, "holders")
    # What most texts hold is dropped before words are shuffled: at most a hundred times the
    # words of an average text.
    common = holders.where((F.col("holders") > limit) & (F.col("holders") * 100 > total)).select("term")
    rare = holders.where(F.col("holders") <= limit)
    inside = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).join(
        owners.select("doc").distinct(), "doc", "left_semi")
    words = words_in(inside, "text").join(F.broadcast(common), "term", "left_anti").join(rare, "term")
    # The same words are the same context, so a document has the hash of all that it holds.
    content = inside.select("doc", F.xxhash64(F.array_sort(F.array_distinct(F.regexp_extract_all(
        F.lower("text"), F.lit(TERM), F.lit(0))))).alias("content")).groupBy("doc").agg(F.min("content").alias("content"))
    own = stored(owners.join(entities, "entity").join(content, "doc").withColumn("most", most(F.col("docs"))), "own")
    near = (found.select("entity", F.xxhash64("words").alias("window"), F.explode(F.array_distinct("words")).alias("term"))
            .distinct().groupBy("entity", "term").agg(F.count("window").alias("windows"))
            .where(F.col("windows") >= min_contexts).select("entity", "term", F.lit(True).alias("near")))
    # Ids that repeat are one document here.
    words = words.dropDuplicates(["doc", "term"])
    # Three different contexts need three different texts of the entity and as many documents of
    # the term; all other pairs can only come from windows, so only those are followed.
    kinds = own.groupBy("entity").agg(F.count_distinct("content").alias("kinds"))
    own = stored(own.join(kinds, "entity"), "own-kinds")
    often, columns = F.col("holders") >= min_contexts, ["entity", "term", "doc", "content", "holders", "docs"]
    spread = (words.where(often).join(own.where(F.col("kinds") >= min_contexts), "doc")
              .where(F.col("holders") <= F.col("most")).select(columns))
    close = (words.join(own.join(near.select("entity", "term"), "entity"), ["doc", "term"])
             .where((F.col("holders") <= F.col("most")) & ~(often & (F.col("kinds") >= min_contexts))).select(columns))
    both = spread.union(close).groupBy("entity", "term").agg(
        F.count("doc").alias("together"), F.count_distinct("content").alias("contents"),
        F.first("holders").alias("holders"), F.first("docs").alias("docs"))
    share = F.col("together") / F.col("holders")
    degree = F.log2(share * total / F.col("docs")) / F.log2(total / F.col("docs"))
    degrees = (both.withColumn("disclosure", degree).where(F.col("disclosure") >= threshold).join(near, ["entity", "term"], "left")
               .where((F.col("contents") >= min_contexts) | F.col("near")))
    terms = stored(degrees.groupBy("term").agg(F.max("disclosure").alias("disclosure")), "terms")
    return None if terms.isEmpty() else terms


def bucket(term, buckets):
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def words_in(docs, text):
    """(the columns of ``docs`` but ``text``, term): each different term of each row."""
    rest = [c for c in docs.columns if c != text]
    return docs.select(*rest, F.explode(F.array_distinct(
        F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TERM), F.lit(0)))).alias("term"))


def candidate_words(docs, text, terms):
    """``words_in``, only terms that are among ``terms``. Most words are dropped by a
    broadcast table of at most ``BUCKETS`` numbers before the exact join."""
    wanted = terms.distinct()
    buckets = min(BUCKETS, max(FEWEST, wanted.count() * PER_TERM))
    marks = wanted.select(bucket("term", buckets).alias("b")).distinct()
    return (words_in(docs, text).join(F.broadcast(marks), bucket("term", buckets) == F.col("b"), "left_semi")
            .join(wanted, "term", "left_semi"))


def term_spans(text, terms, base):
    """The spans of ``terms`` (words of letters) in ``text`` that touch no base span."""
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join(F.array_sort(terms), "|"), F.lit(r")(?![\p{L}\p{N}])"))
    parts = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("found"))
    spans = let(parts, lambda p: placed("term", p["gaps"], p["found"], lambda f: F.lit(True)))
    return F.filter(spans, lambda t: ~F.exists(base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))


def find(docs, doc_id="doc_id", text="text", names=("spans", "terms"), min_contexts=MIN_CONTEXTS,
         threshold=GENERALISE):
    """``docs`` plus the spans (kind, start, end) of personal data by kind as listed, then
    start, and the disclosing terms that the row holds, as (term, disclosure).

    Base spans come first and are never changed; term spans, kind ``term``, touch none of
    them. Null and empty texts have none. Rows with the same id share their list of terms,
    which are then looked for in each row's own text. ``names`` get leading underscores
    where ``docs`` has such columns.
    """
    spans, terms = fresh(docs.columns, names[0]), None
    terms = fresh([*docs.columns, spans], names[1])
    base = docs.withColumn(spans, base_spans(F.col(text)))
    known = disclosing_terms(docs, doc_id, text, min_contexts, threshold)
    empty = F.array().cast("array<struct<term:string,disclosure:double>>")
    if known is None:
        return base.withColumn(terms, empty)
    owner = fresh(base.columns + [terms], "owner")
    held = (candidate_words(docs.select(F.col(doc_id).alias(owner), text), text, known.select("term"))
            .join(known, "term").groupBy(owner)
            .agg(F.array_sort(F.collect_set(F.struct("term", "disclosure"))).alias(terms)))
    joined = base.join(held, base[doc_id].eqNullSafe(held[owner]), "left").drop(owner)
    own = F.transform(terms, lambda t: t["term"])
    return joined.withColumn(spans, F.when(F.col(terms).isNull(), F.col(spans)).otherwise(F.concat(
        F.col(spans), term_spans(F.coalesce(F.col(text), F.lit("")), own, F.col(spans))))).withColumn(
        terms, F.coalesce(terms, empty))


def sanitise(docs, doc_id="doc_id", text="text", min_contexts=MIN_CONTEXTS, generalise=GENERALISE, remove=REMOVE):
    """``docs`` with finds replaced by ``[KIND]``, disclosing terms by ``[TERM]`` or, from
    ``remove`` on, by nothing. Null stays null."""
    found = find(docs, doc_id, text, min_contexts=min_contexts, threshold=generalise)
    terms = found.columns[-1]
    value = F.col(text)

    def masked(kind, gaps, found):
        words = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, f: F.concat(
            g, F.when(valid(kind, f), F.lit(f"[{kind.upper()}]")).otherwise(f)))
        return F.array_join(F.concat(words, F.slice(gaps, -1, 1)), "")

    def replaced(kind):
        return let(pieces(value, PATTERNS[kind], HINTS[kind]), lambda p: masked(kind, p["gaps"], p["found"]))

    for kind in KINDS:
        value = replaced(kind)
    for low, high, mark in ((remove, None, ""), (generalise, remove, "[TERM]")):
        some = F.filter(terms, lambda t: (t["disclosure"] >= low) & (F.lit(high is None) | (t["disclosure"] < (high or 0))))
        words = F.array_sort(F.transform(some, lambda t: t["term"]))
        pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}\[])(?:"), F.array_join(words, "|"), F.lit(r")(?![\p{L}\p{N}\]])"))
        value = F.when(F.size(some) > 0, F.regexp_replace(value, pattern, F.lit(mark))).otherwise(value)
    return found.withColumn(text, F.when(F.col(text).isNotNull(), value)).select(*docs.columns)
