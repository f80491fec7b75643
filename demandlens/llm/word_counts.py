"""How often each word occurs in a text column."""

import numpy as np
import pyarrow as pa
from demandlens.llm.frames import steps
from demandlens.llm.words import NOT_BLANK, Words
from pyspark.sql import functions as F


def word_counts(docs, text="text", inside=NOT_BLANK):
    """(word, n) over all of ``docs``, ``A-Z`` lower-cased; null texts have no words.

    Tasks add up their own words step by step before anything is shuffled, so a word in
    every text is one row per step."""
    def each(batches):
        for part in steps(batches, "text"):
            words = Words(part.column("text"), inside)
            _, first, n = np.unique(words.hashes(), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([words.text(i) for i in first], pa.binary()).cast(pa.string()), pa.array(n, pa.int64())],
                names=["word", "n"])

    rows = docs.select(F.col(text).alias("text")).mapInArrow(each, "word string, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))
