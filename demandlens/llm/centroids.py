"""Language identification by the nearest of several centroids per language.

A text becomes a vector of hashed byte trigrams (letters only, ``A-Z`` lower-cased, runs of
anything else one blank), weighted by ln(1 + tf) * idf and scaled to length 1. Document
frequencies come from all training texts, as one row of counts per dimension. Each
language's vectors are clustered by spherical k-means on a bounded sample, and a text goes
to the language of the centroid with the largest cosine. A text whose distance to that
centroid is beyond the centroid's radius is rejected.

Only the ``FEATURES`` document frequencies and the centroids reach the driver; their
number is fixed by the parameters and the number of languages, which is checked.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from demandlens.llm.frames import fresh, steps
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, FloatType, LongType, StringType,
                               StructType)

BITS = 13
FEATURES = 1 << BITS
CENTROIDS = 3
#: Training texts per language that k-means sees, chosen by the hash of the text.
SAMPLE = 1_000
ROUNDS = 12
#: A language needs a vector of FEATURES floats per centroid in every task.
MAX_LANGUAGES = 500
#: A centroid's radius is this quantile of the distances of all labelled texts that are nearest
#: to it in their language, so odd or mislabelled ones do not widen it, times the slack. It
#: always leaves more likeness than texts of foreign letters have by chance.
QUANTILE, SLACK = 0.995, 1.1
LEAST_COSINE = 0.08
#: A centroid known from a few alike texts still takes others as near as this.
LEAST_RADIUS = 0.5
UNDETERMINED = "und"
DOCS_PER_STEP = 256

#: Byte -> the byte that counts for it: letters lower-cased, beyond ASCII as it is, else blank.
FOLD = np.full(256, 32, np.uint8)
FOLD[128:] = np.arange(128, 256)
FOLD[ord("a"):ord("z") + 1] = FOLD[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def counts(texts):
    """The trigram counts of each text, a row of ``FEATURES`` each; null as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = FOLD[np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]]] if data else np.empty(0, np.uint8)
    bounds = bounds - bounds[0]
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    # one blank for a run of them, and one before and after each text
    blank = raw == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    raw, owner = raw[keep], owner[keep]
    first = np.searchsorted(owner, np.arange(len(texts)))
    raw, owner = np.insert(raw, first, 32), np.insert(owner, first, np.arange(len(texts)))
    raw, owner = np.append(raw, [32, 32]).astype(np.uint32), np.append(owner, [-1, -1])
    code = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
    slot = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
    # a trigram may take the next text's leading blank as its end, never more
    whole = (owner[:-2] == owner[1:-1]) & (raw[1:-1] != 32)
    place = owner[:-2][whole] * FEATURES + slot[whole].astype(np.int64)
    return np.bincount(place, minlength=len(texts) * FEATURES).reshape(len(texts), FEATURES)


def vectors(texts, idf):
    """Unit vectors; a text without letters has the zero vector."""
    found = counts(texts).astype(np.float32)
    np.log1p(found, out=found, where=found > 0)
    found *= idf
    size = np.sqrt((found ** 2).sum(axis=1, keepdims=True))
    return found / np.where(size > 0, size, 1)


def parts(batches, column):
    """Batches of few texts: the dense rows of a step stay within some MB."""
    for part in steps(batches, column):
        for begin in range(0, part.num_rows, DOCS_PER_STEP):
            yield part.slice(begin, DOCS_PER_STEP)


def document_frequencies(docs, text):
    """(number of texts, texts with each feature) over all of ``docs``."""
    def each(batches):
        total, seen = 0, np.zeros(FEATURES, np.int64)
        for part in parts(batches, "text"):
            total += part.num_rows
            seen += (counts(part.column("text")) > 0).sum(axis=0)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(seen[at], total))],
                                         names=["feature", "n"])

    rows = (docs.select(F.col(text).alias("text")).mapInArrow(each, "feature long, n long")
            .groupBy("feature").agg(F.sum("n").alias("n")).collect())  # at most FEATURES + 1 rows
    total, seen = 0, np.zeros(FEATURES)
    for feature, n in rows:
        if feature < 0:
            total = n
        else:
            seen[feature] = n
    return total, seen


def spherical_kmeans(points, k, rounds=ROUNDS):
    """(centroids, cluster of each point). The start splits the points into ``k`` equal
    slices along their main axis, which no single odd point can claim."""
    axis = points - points.mean(axis=0)
    main = axis[int(np.argmax((axis ** 2).sum(axis=1)))]
    for _ in range(rounds):
        main = (axis @ main) @ axis
        main = main / max(np.sqrt((main ** 2).sum()), 1e-12)
    slices = np.array_split(np.argsort(axis @ main, kind="stable"), min(k, len(points)))
    centres = np.array([points[x].sum(axis=0) for x in slices])
    centres /= np.maximum(np.sqrt((centres ** 2).sum(axis=1, keepdims=True)), 1e-12)
    for _ in range(rounds):
        own = np.argmax(points @ centres.T, axis=1)
        for c in range(len(centres)):
            if (own == c).any():
                centre = points[own == c].sum(axis=0)
                centres[c] = centre / max(np.sqrt((centre ** 2).sum()), 1e-12)
    return centres, np.argmax(points @ centres.T, axis=1)


@dataclass
class Model:
    """``idf``, the centroids row by row, and each one's language and radius."""

    idf: np.ndarray
    centres: np.ndarray
    languages: list
    radius: np.ndarray


def distances(labelled, idf, centres, languages):
    """The ``QUANTILE`` of the distances of all rows (text, lang) to the nearest centroid of
    their own language, per centroid; 0 for one that no row is nearest to."""
    away = np.zeros(len(languages))
    if not languages:
        return away
    shared = labelled.sparkSession.sparkContext.broadcast((idf, centres, np.array(languages)))

    def each(batches):
        idf, centres, languages = shared.value
        for part in parts(batches, "text"):
            own = np.array(part.column("lang").to_pylist())[:, None] == languages[None, :]
            cosine = np.where(own, vectors(part.column("text"), idf) @ centres.T, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cosine.argmax(axis=1), pa.int64()), pa.array(1 - cosine.max(axis=1).astype(float))],
                names=["c", "away"])

    rows = (labelled.select("text", "lang").mapInArrow(each, "c bigint, away double").groupBy("c")
            .agg(F.percentile_approx("away", QUANTILE).alias("away")).collect())  # at most one row per centroid
    for r in rows:
        away[r["c"]] = r["away"]
    return away


def train(docs, text="text", lang="lang", k=CENTROIDS, sample=SAMPLE):
    """A ``Model`` from the rows of ``docs`` with a text that has letters and a language.

    Document frequencies cover all those rows; clustering sees about ``sample`` rows per
    language, taken by the hash of the text, so copies are taken or left together. Radii
    come from the distances of all those rows again.
    """
    labelled = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}"))
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("rows"))
    known = sizes.limit(MAX_LANGUAGES + 1).collect()
    if len(known) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages; raise MAX_LANGUAGES or merge labels")
    total, seen = document_frequencies(labelled, "text")
    idf = (np.log((1 + total) / (1 + seen)) + 1).astype(np.float32)
    share = F.create_map(*[F.lit(x) for r in known for x in (r["lang"], min(1.0, sample / r["rows"]))]) if known else None
    schema = StructType().add("lang", StringType()).add("centre", ArrayType(FloatType()))

    def cluster(rows):
        points = np.concatenate([vectors(pa.array(rows["text"][i:i + DOCS_PER_STEP], pa.string()), idf)
                                 for i in range(0, len(rows), DOCS_PER_STEP)])
        centres, own = spherical_kmeans(points, k)
        used = np.unique(own)
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "centre": [centres[c].tolist() for c in used]})

    found = []
    if known:
        draw = F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
        chosen = labelled.where(draw < share[F.col("lang")])
        found = chosen.groupBy("lang").applyInPandas(cluster, schema).collect()
        rest = {r["lang"] for r in known} - {r["lang"] for r in found}
        if rest:  # all texts of a small language drew high
            one = labelled.where(F.col("lang").isin(sorted(rest))).groupBy("lang").agg(
                F.min_by("text", F.xxhash64("text")).alias("text"))
            found += one.groupBy("lang").applyInPandas(cluster, schema).collect()
    found.sort(key=lambda r: (r["lang"], r["centre"]))
    centres = np.array([r["centre"] for r in found], np.float32).reshape(-1, FEATURES)
    languages = [r["lang"] for r in found]
    radius = np.clip(distances(labelled, idf, centres, languages) * SLACK, LEAST_RADIUS, 1 - LEAST_COSINE)
    return Model(idf, centres, languages, radius)


def identify(docs, model, text="text", names=("lang_pred", "score", "accepted")):
    """``docs`` plus the predicted language, the cosine to its nearest centroid (0 to 1),
    and whether that is within the centroid's radius.

    Text that is null or has no letter, or a model without languages, gives ``und``, 0
    and false. Equal cosines go to the language first in alphabetical order. ``names``
    get leading underscores where ``docs`` has such columns.
    """
    out = []
    for name in names:
        out.append(fresh(docs.columns + out, name))
    letters = fresh(docs.columns + out, "letters")
    marked = docs.withColumn(letters, F.coalesce(F.col(text).rlike("\\p{L}"), F.lit(False)))
    schema = StructType(list(docs.schema.fields))
    schema = schema.add(out[0], StringType()).add(out[1], DoubleType()).add(out[2], BooleanType())
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def each(batches):
        model = shared.value
        for part in parts(batches, text):
            has = part.column(letters).to_numpy(zero_copy_only=False).astype(bool)
            score, best = np.zeros(part.num_rows), np.zeros(part.num_rows, np.int64)
            if len(model.languages):
                cosine = vectors(part.column(text), model.idf) @ model.centres.T
                best = cosine.argmax(axis=1)
                score = np.where(has, np.clip(cosine.max(axis=1).astype(float), 0, 1), 0.0)
            else:
                has = np.zeros(part.num_rows, bool)
            lang = [model.languages[b] if h else UNDETERMINED for b, h in zip(best, has)]
            within = has & (1 - score <= (model.radius[best] if len(model.languages) else 0))
            yield pa.RecordBatch.from_arrays(
                [c for n, c in zip(part.schema.names, part.columns) if n != letters]
                + [pa.array(lang, pa.string()), pa.array(score), pa.array(within)], names=schema.names)

    return marked.mapInArrow(each, schema)
