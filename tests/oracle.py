"""Runs registered queries against their oracle SQL in DuckDB and compares rows, names and values."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations").split()

_FAMILY = {
    "BIGINT": "bigint", "HUGEINT": "hugeint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "DATE": "date", "BOOLEAN": "boolean", "SMALLINT": "smallint", "TINYINT": "tinyint", "TIMESTAMP": "timestamp",
    "FLOAT": "float",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, Decimal)):
        return f"{float(v):.10g}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(df, con, text: str) -> list[str]:
    """Problems found; empty when both sides agree."""
    cur = con.execute(text)
    their_names = [d[0] for d in cur.description]
    their_types = dict(zip(their_names, [str(t[1]) for t in cur.description]))
    theirs = cur.fetchall()
    ours = [tuple(r) for r in df.collect()]
    problems = []
    if sorted(df.columns) != sorted(their_names):
        return [f"columns {sorted(df.columns)} != {sorted(their_names)}"]
    for name, spark_type in df.dtypes:
        want = _FAMILY.get(their_types[name].upper())
        if want and want != spark_type:
            problems.append(f"type of {name}: {spark_type} != {their_types[name]}")
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} != {len(theirs)}")
    if not ours:
        problems.append("no rows")
    a, b = _rows(df.columns, ours), _rows(their_names, theirs)
    if a != b:
        sa, sb = set(a), set(b)
        problems.append(f"values differ: {sorted(df.columns)} only ours {sorted(sa - sb)[:2]} only theirs {sorted(sb - sa)[:2]}")
    return problems


def main(argv):
    import __spark_entry__ as entry
    from tests.conftest import make_session

    sf_dir = "/root/testdata/sf0.01"
    spark = make_session()
    con = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    picked = [k for k in queries if not argv or any(k == a or (a.endswith("*") and k.startswith(a[:-1])) for a in argv)]
    bad = 0
    for key in picked:
        start = time.time()
        try:
            df = queries[key](spark, sf_dir)
            if key in oracle:
                problems = compare(df, con, oracle[key])
            else:
                n = len(df.collect())
                problems = [] if n else ["no rows"]
        except Exception as e:  # report and go on with the next query
            problems = [f"{type(e).__name__}: {str(e)[:700]}"]
        bad += bool(problems)
        kind = "oracle" if key in oracle else "rows"
        print(f"{'FAIL' if problems else 'ok  '} {kind:6} {key:32} {time.time() - start:6.2f}s {' | '.join(problems)}", flush=True)
    print(f"{len(picked) - bad}/{len(picked)} agree")


if __name__ == "__main__":
    main(sys.argv[1:])
