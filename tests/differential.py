"""Run registered queries in Spark and their SQL in DuckDB, and compare values.

Also a script: ``python tests/differential.py <sf_dir> [query ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

INPUTS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(sf_dir: str):
    db = duckdb.connect()
    for name in INPUTS:
        db.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return db


def plain(value):
    if isinstance(value, float):
        assert not math.isnan(value), "NaN in a result"
        return value + 0.0
    return value


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, db, sf_dir: str, build, sql: str) -> list[str]:
    """Differences between the two results, empty when equal."""
    df = build(spark, sf_dir)
    ours = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    theirs = canonical(names, result.fetchall())
    problems = []
    if sorted(df.columns) != sorted(names):
        problems.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} != {len(theirs)}")
    differing = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if differing:
        problems.append(f"{len(differing)} rows differ, e.g. {differing[0][0]} != {differing[0][1]}")
    for a, b in zip(ours[0] if ours else (), theirs[0] if theirs else ()):
        if a is not None and b is not None and type(a) is not type(b):
            problems.append(f"types {type(a).__name__} != {type(b).__name__} ({a!r}, {b!r})")
    return problems


def main(sf_dir: str, wanted: list[str]) -> int:
    import __spark_entry__ as entry
    from tests.conftest import new_session

    spark, db = new_session(), connect(sf_dir)
    checks, failed = entry.oracle_sql(), 0
    for name, build in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in checks:
                problems = compare(spark, db, sf_dir, build, checks[name])
            else:
                problems = [] if build(spark, sf_dir).count() else ["no rows"]
        except Exception as error:  # reported per query
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(problems)
        kind = "sql" if name in checks else "rows"
        print(f"{'FAIL' if problems else 'ok':4} {kind:4} {time.time() - start:6.1f}s {name}", *problems,
              sep="\n       " if problems else " ", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
