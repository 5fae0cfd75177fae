"""Runs a registered query and its SQL twin on the same tables and compares them exactly.

    python -m tests.compare [--dir DIR] [key ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
    "boolean": "BOOLEAN", "float": "FLOAT", "timestamp": "TIMESTAMP",
    "array<string>": "VARCHAR[]", "array<float>": "FLOAT[]", "array<double>": "DOUBLE[]", "array<int>": "INTEGER[]", "array<bigint>": "BIGINT[]",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return [canonical(v) for v in value]
    return value


def differences(spark, con, fn, sql: str, sf_dir: str) -> str:
    """'' when columns, types and the multiset of rows agree."""
    df = fn(spark, sf_dir)
    theirs = con.execute(sql)
    mine_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    their_types = {d[0]: str(d[1]) for d in theirs.description}
    if mine_types != their_types:
        return f"columns differ: {mine_types} / {their_types}"
    names = sorted(mine_types)
    order = [d[0] for d in theirs.description]
    left = sorted(repr([canonical(r[n]) for n in names]) for r in df.collect())
    right = sorted(repr([canonical(r[order.index(n)]) for n in names]) for r in theirs.fetchall())
    if left != right:
        only_left = [x for x in left if x not in set(right)]
        only_right = [x for x in right if x not in set(left)]
        return (
            f"rows {len(left)} / {len(right)}; {len(only_left)} only in Spark, {len(only_right)} only in SQL\n"
            + "\n".join("  S " + x[:400] for x in only_left[:3])
            + "\n"
            + "\n".join("  D " + x[:400] for x in only_right[:3])
        )
    return "" if left else "both empty"


def main(argv: list[str]) -> None:
    from __spark_entry__ import oracle_sql, queries

    from forumlens.session import get_session

    sf_dir = "/root/testdata/sf0.01"
    if argv and argv[0] == "--dir":
        sf_dir, argv = argv[1], argv[2:]
    spark = get_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                       "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    fns, sqls = queries(), oracle_sql()
    wanted = [k for k in fns if not argv or any(k.startswith(a) for a in argv)]
    bad = 0
    for key in wanted:
        start = time.time()
        try:
            if key in sqls:
                result = differences(spark, con, fns[key], sqls[key], sf_dir)
            else:
                rows = fns[key](spark, sf_dir).collect()
                result = f"rows only: {len(rows)}" if rows else "no rows"
        except Exception as exc:  # report and go on with the next key
            result = f"{type(exc).__name__}: {str(exc)[:600]}"
        ok = result == "" or result.startswith("rows only")
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {time.time() - start:6.1f}s {key} {result}", flush=True)
    print(f"{len(wanted)} queries, {bad} bad")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
