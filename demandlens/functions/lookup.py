"""A small dictionary inside an expression, with constant-time lookups.

A map literal is searched key by key. Spreading the entries over an array of
maps by a checksum of the key leaves one or two keys to compare, for a
vocabulary of any size that fits into a plan.
"""

import json
import zlib

from pyspark.sql import functions as F


def lookup(pairs, kind):
    """Function key column -> value of type ``kind`` (null if absent)."""
    buckets = [{} for _ in range(max(1, len(pairs)))]
    for key, value in pairs.items():
        buckets[zlib.crc32(key.encode("utf-8")) % len(buckets)][key] = value
    table = F.from_json(F.lit(json.dumps(buckets, ensure_ascii=False)),
                        f"array<map<string,{kind}>>")
    return lambda key: F.try_element_at(
        F.get(table, F.pmod(F.crc32(key), F.lit(len(buckets))).cast("int")), key)
