"""Runs registered queries beside their comparison SQL: ``python tests/compare.py [sf_dir] [names]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DATA = "/root/testdata/sf0.01"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    for name in frame.columns:
        if pd.api.types.is_datetime64_any_dtype(frame[name]):
            frame = frame.assign(**{name: frame[name].astype("datetime64[us]")})
    rows = frame.astype(object).where(frame.notna(), None).itertuples(index=False, name=None)
    return sorted(tuple("" if v is None else str(v) for v in row) for row in rows)


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """None if both sides agree on columns and values, else what differs."""
    from quakeframe.plans.registry import ORACLES, QUERIES

    ours = QUERIES[name](spark, sf_dir)
    theirs = con.execute(ORACLES[name]).fetchdf()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} / {sorted(theirs.columns)}"
    a, b = canonical(ours.toPandas()), canonical(theirs)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
        return f"{len(a)} / {len(b)} rows; only ours {only_a}; only theirs {only_b}"
    difference.rows = len(a)
    kinds = [(n, t) for n, t in ours.dtypes if t in ("date", "int") and theirs[n].isna().any()]
    if kinds:
        return f"nullable whole numbers or dates {kinds}"
    return None


if __name__ == "__main__":
    from quakeframe.plans.registry import ORACLES, QUERIES
    from quakeframe.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else DATA
    names = sys.argv[2:] or list(QUERIES)
    session, con = local_session(8), duck(folder)
    bad = 0
    for name in names:
        begin = time.time()
        try:
            if name in ORACLES:
                problem = difference(session, con, name, folder)
                rows = difference.rows
            else:
                problem, rows = None, QUERIES[name](session, folder).count()
        except Exception as error:  # noqa: BLE001
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", 0
        bad += problem is not None
        print(f"{'BAD ' if problem else 'ok  '} {name:36s} {time.time() - begin:6.2f}s {'' if problem else rows} {problem or ''}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
