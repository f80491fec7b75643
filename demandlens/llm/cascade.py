"""Quality rules as a short-circuit cascade, in column expressions only.

Every rule is one condition over the text. On a bounded sample each rule is run alone,
which gives its cost (seconds above reading the sample) and its rejections; rules are then
ordered by rejections per cost and chained in one CASE, so a row is tested no further
than the first rule that rejects it. The order changes the work, never the verdict:
a row is kept if and only if no rule rejects it.
"""

import time

from demandlens.llm.frames import BLANKS, fresh, stored
from pyspark.sql import functions as F

#: Words in a window whose repetition counts.
WINDOW = 5
#: Rows that costs and rejections are estimated on, chosen by hash.
SAMPLE_ROWS = 2_000
TRIALS = 2

BLANK_RUN = "[ \\x09-\\x0D]+"
NO_SYMBOLS = "[^#*$%&|<>]+"


def let(value, use):
    """``use`` of ``value``, which is evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text):
    """The words between ASCII blanks; null has none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK_RUN))


def lines_of(text):
    """The lines that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")


def repeat_words(words):
    """How many words lie in a window of ``WINDOW`` words that the text has twice or more.

    Windows are compared by a 64-bit hash. Only a text with some equal hashes is sorted."""
    hashes = F.slice(F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, WINDOW)])),
                     F.lit(1), F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))

    def covered(h):
        order = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        again = let(order, lambda s: F.filter(s, lambda e, j: (
            F.coalesce(e["h"] == F.get(s, j + 1)["h"], F.lit(False))
            | ((j > 0) & (e["h"] == F.get(s, F.greatest(j - 1, F.lit(0)))["h"])))))
        at = F.sort_array(F.transform(again, lambda e: e["at"]))
        steps = let(at, lambda p: F.transform(p, lambda v, j: F.least(
            F.coalesce(F.get(p, j + 1) - v, F.lit(WINDOW)), F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h))
               .otherwise(F.lit(0).cast("long")))


def measures(text):
    """The figures that rules use, each as one expression over the text column."""
    words, lines = words_of(text), lines_of(text)
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(F.coalesce(text, F.lit("")), NO_SYMBOLS, "")).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": let(words, repeat_words),
        "n_letters": F.length(F.regexp_replace(F.coalesce(text, F.lit("")), "[^\\p{L}]+", "")).cast("long"),
        "n_capitals": F.length(F.regexp_replace(F.coalesce(text, F.lit("")), "[^\\p{Lu}]+", "")).cast("long"),
    }


def measured(docs, text, names):
    """``docs`` plus the named figures, with the words split once for all of them.
    Returns the table and name -> column."""
    words, out = fresh(docs.columns, "words"), {}
    table = docs.withColumn(words, words_of(F.col(text)))
    figures = measures(F.col(text)) | {
        "n_words": F.size(words).cast("long"), "n_repeat_words": repeat_words(F.col(words)),
        "word_chars": F.length(F.array_join(words, "")).cast("long")}
    for name in names:
        out[name] = fresh(table.columns + list(out.values()), name)
    table = table.select("*", *[figures[n].alias(own) for n, own in out.items()]).drop(words)
    return table, {n: F.col(own) for n, own in out.items()}


def rules(figure):
    """Rule name -> condition that rejects, over a mapping of figures to expressions.

    Names starting with ``base_`` are the fixed base rules."""
    return {
        "base_few_words": figure["n_words"] < 10,
        "base_repeats": 100 * figure["n_repeat_words"] > 20 * figure["n_words"],
        "symbols": 100 * figure["n_symbols"] > 10 * figure["word_chars"],
        "repeated_lines": (figure["n_lines"] >= 4) & (100 * figure["n_dup_lines"] > 40 * figure["n_lines"]),
        "word_length": (figure["word_chars"] < 2 * figure["n_words"])
        | (figure["word_chars"] > 25 * figure["n_words"]),
        "few_letters": 100 * figure["n_letters"] < 50 * figure["word_chars"],
        "capitals": 100 * figure["n_capitals"] > 60 * figure["n_letters"],
    }


def sample_of(docs, text, rows):
    """About ``rows`` rows by hash of the text, all rows of a smaller table."""
    total = docs.count()
    share = min(1.0, rows / max(total, 1))
    return docs.where(F.pmod(F.xxhash64(F.col(text)), F.lit(1 << 30)) < int(share * (1 << 30)))


def ordered(docs, conditions, text="text", rows=SAMPLE_ROWS):
    """The rule names by falling rejections per second on a sample of ``docs``."""
    sample = stored(sample_of(docs.select(F.col(text).alias("text")), "text", rows), "rule-sample")

    def seconds(condition):
        taken, rejected = [], 0
        for _ in range(TRIALS):
            start = time.perf_counter()
            rejected = sample.agg(F.count_if(condition)).first()[0]
            taken.append(time.perf_counter() - start)
        return min(taken), rejected

    base, _ = seconds(F.octet_length("text") < 0)
    scores = {}
    for name, condition in conditions.items():
        cost, rejected = seconds(condition)
        scores[name] = rejected / max(cost - base, 1e-3)
    return sorted(conditions, key=lambda n: (-scores[n], n))


def verdict(conditions, order):
    """The first rule of ``order`` that rejects, null where none does. A condition that is
    null (no figure) does not reject."""
    chain = F
    for name in order:
        chain = chain.when(conditions[name], F.lit(name))
    return chain.otherwise(F.lit(None).cast("string"))


def apply_rules(docs, text="text", name="rejected_by", rows=SAMPLE_ROWS):
    """``docs`` plus the rule that rejects each row first, or null.

    A null or blank text has no words and is rejected for that. Which of several rejecting
    rules is named depends on the measured order; whether a row is rejected does not.
    ``name`` gets leading underscores where ``docs`` has such a column.
    """
    order = ordered(docs, rules(measures(F.col("text"))), text, rows)
    return docs.withColumn(fresh(docs.columns, name), verdict(rules(measures(F.col(text))), order))
