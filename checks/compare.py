"""Compare registered queries with their SQL: ``python -m checks.compare [sf_dir] [name ...]``."""

import sys
import time

import duckdb

from centstream.session import build_session
from checks import oracles
from checks import queries as registered

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_rows(sf_dir: str, statement: str) -> tuple[list[str], list[tuple]]:
    with duckdb.connect() as db:
        for table in TABLES:
            path = f"{sf_dir}/{table}.parquet"
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
        result = db.execute(statement)
        return [column[0] for column in result.description], result.fetchall()


def canonical(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    """Columns by name, rows in a fixed order."""
    order = sorted(range(len(names)), key=names.__getitem__)
    moved = [tuple(row[i] for i in order) for row in rows]
    return sorted(names), sorted(moved, key=repr)


def difference(spark, name: str, sf_dir: str) -> str | None:
    """What differs, or None."""
    frame = registered.queries()[name](spark, sf_dir)
    got_names, got = canonical(frame.columns, [tuple(row) for row in frame.collect()])
    names, want = canonical(*oracle_rows(sf_dir, oracles.sql()[name]))
    if got_names != names:
        return f"columns {got_names} are not {names}"
    if len(got) != len(want):
        return f"{len(got)} rows are not {len(want)}"
    for mine, theirs in zip(got, want, strict=True):
        if repr(mine) != repr(theirs):
            return f"{mine} is not {theirs}"
    return None


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    conf = {"spark.master": "local[8]", "spark.ui.enabled": "false"}
    spark = build_session("compare", 8, conf)
    spark.sparkContext.setLogLevel("ERROR")
    wrong = 0
    for name in names or registered.QUERIES:
        began = time.perf_counter()
        found = difference(spark, name, sf_dir)
        wrong += found is not None
        print(f"{name:24s} {time.perf_counter() - began:6.2f}s {found or 'same'}", flush=True)
    return wrong


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
