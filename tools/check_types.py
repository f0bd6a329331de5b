"""Compare output column types of Spark queries and their DuckDB oracle."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from shelfmark.session import get_session  # noqa: E402
from shelfmark.sources.tables import TABLES, table_path  # noqa: E402

SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT",
                 "array<string>": "VARCHAR[]", "array<double>": "DOUBLE[]",
                 "array<bigint>": "BIGINT[]"}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    from shelfmark.registry import ORACLE, QUERIES
    spark = get_session("local[4]", shuffle_partitions=4)
    con = duckdb.connect()
    for t in TABLES:
        p = table_path(sf_dir, t)
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    bad = 0
    for name in sorted(ORACLE):
        sp = {f.name: f.dataType.simpleString() for f in QUERIES[name](spark, sf_dir).schema.fields}
        dk = {r[0]: r[1] for r in con.execute(f"DESCRIBE {ORACLE[name]}").fetchall()}
        diffs = [(c, sp.get(c), dk.get(c)) for c in sorted(set(sp) | set(dk))
                 if SPARK_TO_DUCK.get(sp.get(c), sp.get(c)) != dk.get(c)]
        if diffs:
            bad += 1
            print(name, diffs)
    print("queries with type differences:", bad)
    spark.stop()


if __name__ == "__main__":
    main()
