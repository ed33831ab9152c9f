"""Run the registered queries next to their SQL: python -m checks.compare [sf_dir] [names...]"""

from __future__ import annotations

import sys
import tempfile
import time

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES
from kindred.session import get_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs in columns, types of columns or rows; None if nothing does."""
    expected = con.sql(sql).to_arrow_table()
    columns = sorted(spark_df.columns)
    if columns != sorted(expected.column_names):
        return f"columns {columns} and {sorted(expected.column_names)}"
    got = spark_df.select(*columns).toArrow()
    expected = expected.select(columns)
    types = [(c, str(g), str(e)) for c, g, e in zip(columns, got.schema.types, expected.schema.types) if g != e]
    order = [(c, "ascending") for c in columns]
    rows = [list(t.sort_by(order).to_pylist()) for t in (got, expected)]
    if len(rows[0]) != len(rows[1]):
        return f"{len(rows[0])} rows and {len(rows[1])}"
    wrong = [(g, e) for g, e in zip(*rows) if g != e]
    if wrong:
        return f"{len(wrong)} of {len(rows[0])} rows differ, such as {wrong[0]}"
    return f"types {types}" if types else None


def main(argv: list[str], scratch: str) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8, checkpoint_dir=scratch)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in argv[1:] or QUERIES:
        start = time.time()
        df = QUERIES[name](spark, sf_dir)
        try:
            found = difference(df, con, ORACLE[name])
        except duckdb.Error as error:
            found = f"SQL: {error}"
        bad += found is not None
        print(f"{name:28} {time.time() - start:6.1f}s  {found or 'equal'}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    with tempfile.TemporaryDirectory(prefix="kindred-compare-") as folder:
        sys.exit(main(sys.argv[1:], folder))
