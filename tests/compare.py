"""Compare a registered query with its SQL, run by DuckDB over the same tables.

``python tests/compare.py /root/testdata/sf0.01 [name …]`` prints one line per query.
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(columns, rows):
    """Column names in order, and the rows sorted, their cells in that order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(cells, key=repr)


SAME = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "float": "FLOAT",
}


def compare(spark, con, sf_dir: str, query, sql: str) -> list[str]:
    """What differs; nothing when the results are the same."""
    df = query(spark, sf_dir)
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    described = result.description
    want_columns, want = rows_of([d[0] for d in described], result.fetchall())
    faults = []
    if got_columns != want_columns:
        faults.append(f"columns {got_columns} != {want_columns}")
    types = {name: kind for name, kind in df.dtypes}
    for d in described:
        expected = SAME.get(types.get(d[0]))
        if expected != str(d[1]):
            faults.append(f"type of {d[0]}: {types.get(d[0])} != {d[1]}")
    if len(got) != len(want):
        faults.append(f"rows {len(got)} != {len(want)}")
    if got != want:
        missing = [r for r in want if r not in set(got)][:2]
        extra = [r for r in got if r not in set(want)][:2]
        faults.append(f"missing {missing} extra {extra}")
    if not want:
        faults.append("no rows")
    return faults


def main() -> None:
    from shelfmark.plans import registry
    from shelfmark.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session("8", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    con = connect(sf_dir)
    bad = 0
    for name, query in registry.QUERIES.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in registry.SQL:
                faults = compare(spark, con, sf_dir, query, registry.SQL[name])
            else:
                faults = [] if query(spark, sf_dir).count() else ["no rows"]
        except Exception as error:  # noqa: BLE001
            faults = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(faults)
        print(f"{'BAD' if faults else 'ok '} {name} {time.time() - start:.2f}s", *faults, sep="  ")
    print("bad:", bad)


if __name__ == "__main__":
    main()
