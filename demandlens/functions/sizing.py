"""Broadcasting behind a row check.

A dimension (vocabulary, demand table, search hits per skill) is small in every
case the engine was made for, but it is data. ``pin_small`` looks at no more
than ``limit + 1`` rows; within the limit the rows are computed once and become
a broadcast local table, beyond it the caller gets ``None`` and takes its
shuffle path.
"""

from pyspark.sql import functions as F

SMALL_ROWS = 10_000


def fetch_small(df, limit=SMALL_ROWS):
    """The rows of ``df`` if there are at most ``limit``, else ``None``."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def pin_small(df, limit=SMALL_ROWS):
    rows = fetch_small(df, limit)
    if rows is None:
        return None
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def broadcast_if_small(df, limit=SMALL_ROWS):
    """A broadcast local copy within the limit, ``df`` itself beyond it."""
    pinned = pin_small(df, limit)
    return df if pinned is None else pinned
