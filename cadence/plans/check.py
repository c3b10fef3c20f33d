"""Local twin of the driver's correctness gate: run a registered query in Spark and
its oracle SQL in DuckDB on the same parquet tables, then compare row count,
column names, dtypes and an order-insensitive hash of the values."""

from __future__ import annotations

import hashlib
import sys
import time

import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duckdb_conn(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df


def frame_hash(df: pd.DataFrame) -> str:
    df = _canon(df)
    rows = sorted(repr(tuple(None if (isinstance(v, float) and v != v) or v is None or v is pd.NA else v
                             for v in row)) for row in df.itertuples(index=False, name=None))
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()


def compare(name: str, spark, sf_dir: str, con=None) -> dict:
    from cadence.plans.registry import ORACLES, QUERIES, load_all
    load_all()
    con = con or duckdb_conn(sf_dir)
    t0 = time.time()
    s = QUERIES[name](spark, sf_dir).toPandas()
    t1 = time.time()
    out = {"query": name, "spark_rows": len(s), "spark_sec": round(t1 - t0, 2)}
    if name not in ORACLES:
        out["status"] = "rows-only"
        return out
    d = con.execute(ORACLES[name]).df()
    out["oracle_rows"] = len(d)
    out["rows_ok"] = len(s) == len(d)
    out["cols_ok"] = sorted(s.columns) == sorted(d.columns)
    if out["cols_ok"]:
        sd = _canon(s).dtypes.astype(str).tolist()
        dd = _canon(d).dtypes.astype(str).tolist()
        out["dtypes_ok"] = sd == dd
        if not out["dtypes_ok"]:
            out["dtypes"] = [(c, a, b) for c, a, b in zip(sorted(s.columns), sd, dd) if a != b]
        out["hash_ok"] = frame_hash(s) == frame_hash(d)
        if not out["hash_ok"]:
            ss = _canon(s).sort_values(sorted(s.columns)).reset_index(drop=True)
            dd_ = _canon(d).sort_values(sorted(d.columns)).reset_index(drop=True)
            if len(ss) == len(dd_):
                for c in ss.columns:
                    diff = ss[c].astype(str) != dd_[c].astype(str)
                    if diff.any():
                        k = diff.idxmax()
                        out.setdefault("first_diffs", []).append((c, str(ss[c][k]), str(dd_[c][k])))
    else:
        out["spark_cols"] = sorted(s.columns)
        out["oracle_cols"] = sorted(d.columns)
    out["status"] = "ok" if all(out.get(k) for k in ("rows_ok", "cols_ok", "dtypes_ok", "hash_ok")) else "MISMATCH"
    return out


def main(argv: list[str]) -> int:
    from cadence.plans.registry import QUERIES, load_all
    from cadence.session import get_session
    load_all()
    sf_dir = "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("--")] or sorted(QUERIES)
    spark = get_session("local[8]")
    con = duckdb_conn(sf_dir)
    bad = 0
    for n in names:
        matches = [q for q in QUERIES if q.startswith(n)]
        for q in matches:
            try:
                res = compare(q, spark, sf_dir, con)
            except Exception as e:  # report and go on
                res = {"query": q, "status": "ERROR", "error": repr(e)[:600]}
            bad += res["status"] not in ("ok", "rows-only")
            print(res, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
