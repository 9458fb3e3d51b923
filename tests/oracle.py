"""Run the registered queries beside their reference SQL.

    python tests/oracle.py [folder] [query ...]
"""

from __future__ import annotations

import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return str(value.normalize() if value else Decimal(0))
    if isinstance(value, float):
        return f"{value:.9g}"
    return "" if value is None else f"{type(value).__name__}:{value}"


FAMILY = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def family(text: str) -> str:
    text = text.lower()
    if text.startswith("decimal"):
        return text.replace(" ", "").upper()
    return FAMILY.get(text, text.upper())


def compare(con, df, sql: str) -> str | None:
    """``None`` if columns, types and rows agree, else what differs."""
    names = sorted(df.columns)
    relation = con.sql(sql)
    theirs = sorted(relation.columns)
    if names != theirs:
        return f"columns {names} != {theirs}"
    ours_types = {f.name: family(f.dataType.simpleString()) for f in df.schema.fields}
    their_types = {c: family(str(t)) for c, t in zip(relation.columns, relation.types)}
    if ours_types != their_types:
        return f"types {[(n, ours_types[n], their_types[n]) for n in names if ours_types[n] != their_types[n]]}"
    mine = sorted(tuple(plain(r[n]) for n in names) for r in df.select(*[f"`{n}`" for n in names]).collect())
    order = ", ".join(f'"{n}"' for n in names)
    other = sorted(tuple(plain(v) for v in r) for r in con.sql(f"SELECT {order} FROM ({sql})").fetchall())
    if mine == other:
        return None
    extra, missing = [r for r in mine if r not in set(other)][:2], [r for r in other if r not in set(mine)][:2]
    return f"rows {len(mine)} != {len(other)}; only ours {extra}; only theirs {missing}"


def main() -> int:
    from tidemark.catalog import QUERIES, REFERENCE_SQL
    from tidemark.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    spark, con, bad = local_session(8), connect(folder), 0
    # A zone with clock changes: results must not depend on it.
    spark.conf.set("spark.sql.session.timeZone", os.environ.get("SESSION_ZONE", "UTC"))
    for name in wanted:
        started = time.monotonic()
        try:
            df = QUERIES[name](spark, folder)
            if name in REFERENCE_SQL:
                verdict = compare(con, df, REFERENCE_SQL[name])
            else:
                verdict = None if df.count() >= 0 else "no rows"
        except Exception as error:  # noqa: BLE001
            verdict = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += verdict is not None
        print(f"{'ok ' if verdict is None else 'BAD'} {name} {time.monotonic() - started:.2f}s {verdict or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
