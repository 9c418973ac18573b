"""Run queries in Spark and DuckDB side by side: names, types, row counts, values.

    python tests/check_oracle.py [sf dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
TYPES = {
    "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double",
    "BOOLEAN": "boolean", "DATE": "date",
}


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _rows(rows, order):
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark_df, connection, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    cursor = connection.execute(sql)
    described = [(d[0], str(d[1])) for d in cursor.description]
    theirs = cursor.fetchall()
    ours = spark_df.collect()
    our_types = dict(spark_df.dtypes)
    their_types = {name: TYPES.get(kind, kind) for name, kind in described}
    if set(our_types) != set(their_types):
        return f"columns differ: {sorted(set(our_types) ^ set(their_types))}"
    if our_types != their_types:
        wrong = {n: (our_types[n], their_types[n]) for n in our_types if our_types[n] != their_types[n]}
        return f"types differ: {wrong}"
    names = sorted(our_types)
    left = _rows(ours, [spark_df.columns.index(n) for n in names])
    right = _rows(theirs, [[d[0] for d in described].index(n) for n in names])
    if len(left) != len(right):
        return f"rows differ: {len(left)} here, {len(right)} there"
    if left != right:
        bad = [(a, b) for a, b in zip(left, right) if a != b]
        cells = [(n, x, y) for n, x, y in zip(names, *bad[0]) if x != y]
        return f"{len(bad)} of {len(left)} rows differ, first in {cells}"
    return None if left else "no rows"


def main() -> int:
    import __spark_entry__ as entry
    from tarmac.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    connection = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = sorted(set(oracles) - set(queries))
    for name in sys.argv[2:] or oracles:
        start = time.time()
        try:
            problem = compare(queries[name](spark, sf_dir), connection, oracles[name])
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(queries)} queries, {len(oracles)} oracles, failed: {failed}")
    return len(failed)


if __name__ == "__main__":
    sys.exit(main())
