"""Run queries against their SQL: python tests/compare.py SF_DIR [name ...]"""

import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(row[i] for i in order) for row in rows], key=repr)


def difference(spark_df, con, sql):
    """``None`` if both results agree, else a short text."""
    got = [tuple(r) for r in spark_df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    got, want = normal(got, spark_df.columns), normal(want, names)
    if len(got) != len(want):
        return f"{len(got)} rows, SQL has {len(want)}"
    for a, b in zip(got, want):
        if repr(a) != repr(b):
            return f"{a} != {b}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from demandlens.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(master=os.environ.get("COMPARE_MASTER", "local[8]"), **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle = connect(sf_dir), entry.oracle_sql()
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            found = difference(df, con, oracle[name]) if name in oracle else f"rows only: {len(df.collect())}"
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:700]}"
        print(f"{name:26s} {time.time() - start:6.1f}s {found or 'ok'}", flush=True)
