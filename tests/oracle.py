"""Runs a registered query and its SQL twin side by side."""

from __future__ import annotations

import datetime as dt
import glob
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return (type(value).__name__, repr(value))


def table_rows(arrow) -> tuple[dict[str, str], list]:
    names = sorted(arrow.column_names)
    types = {n: str(arrow.schema.field(n).type) for n in names}
    columns = [[_plain(v) for v in arrow.column(n).to_pylist()] for n in names]
    return types, sorted(zip(*columns)) if columns else []


def compare(spark, con, query, sql, sf_dir) -> str | None:
    """None when rows, names and types agree, else what differs."""
    got_types, got = table_rows(query(spark, sf_dir).toArrow())
    result = con.execute(sql)
    expect_types, expect = table_rows(result.to_arrow_table() if hasattr(result, "to_arrow_table") else result.arrow())
    soft = {"large_string": "string"}
    a = {k: soft.get(v, v).split("[")[0] for k, v in got_types.items()}
    b = {k: soft.get(v, v).split("[")[0] for k, v in expect_types.items()}
    if a != b:
        return f"types differ: {[(k, a.get(k), b.get(k)) for k in sorted({*a, *b}) if a.get(k) != b.get(k)]}"
    if got != expect:
        only_a = [x for x in got if x not in set(expect)][:2]
        only_b = [x for x in expect if x not in set(got)][:2]
        return f"{len(got)} rows against {len(expect)}; only Spark {only_a}; only SQL {only_b}"
    return None
