"""Hash draws that are the same in every run, partitioning and SQL engine.

``rand(seed)`` and ``shuffle`` depend on how rows are spread over partitions,
so a task that is run again after a lost executor may draw differently. These
draws depend on the row's key only.
"""

import math

from pyspark.sql import functions as F

_SPAN = 2 ** 48


def draw_text(*parts):
    """MD5 text of the parts, joined by ``|``; sorts in random order."""
    return F.md5(F.concat_ws("|", *[p.cast("string") if hasattr(p, "cast") else F.lit(p)
                                    for p in parts]))


def draw_long(*parts):
    """Integer in [0, 2**48) from the parts."""
    return F.conv(F.substring(draw_text(*parts), 1, 12), 16, 10).cast("long")


def draw_unit(*parts):
    """Double in [0, 1)."""
    return draw_long(*parts) / F.lit(float(_SPAN))


def draw_int(low, high, *parts):
    """Integer in [low, high]."""
    return (F.lit(low) + F.floor(draw_unit(*parts) * (high - low + 1))).cast("int")


def draw_gauss(*parts):
    """Standard normal value (Box-Muller over two draws)."""
    u = 1.0 - draw_unit(*parts, "u")
    v = draw_unit(*parts, "v")
    return F.sqrt(F.log(u) * -2.0) * F.cos(v * (2.0 * math.pi))


def draw_subset(pool, size, *parts):
    """``size`` different elements of the array ``pool``, in random order."""
    keyed = F.transform(pool, lambda s: F.struct(draw_text(*parts, s).alias("h"), s.alias("s")))
    return F.transform(F.slice(F.sort_array(keyed), 1, size), lambda x: x["s"])
