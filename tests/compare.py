"""Spark-vs-DuckDB result comparison (the same check the driver runs), for tests and dev."""

from __future__ import annotations

import glob
import os

import pandas as pd


def duckdb_views(con, sf_dir: str) -> None:
    for p in sorted(glob.glob(os.path.join(sf_dir, "*.parquet"))):
        name = os.path.splitext(os.path.basename(p))[0]
        con.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM read_parquet('{p}')")


def _canon(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        s = df[c]
        if pd.api.types.is_float_dtype(s):
            df[c] = s.round(4).map(lambda v: None if pd.isna(v) else f"{v + 0.0:.4f}")
        elif pd.api.types.is_datetime64_any_dtype(s):
            midnight = bool((s.dropna() == s.dropna().dt.normalize()).all())
            df[c] = s.dt.strftime("%Y-%m-%d" if midnight else "%Y-%m-%d %H:%M:%S")
        else:
            df[c] = s.map(lambda v: None if v is None or (isinstance(v, float) and pd.isna(v))
                          else str(v.isoformat() if hasattr(v, "isoformat") else v))
    return df.sort_values(list(df.columns), na_position="last").reset_index(drop=True)


def compare(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame) -> dict:
    out = {"rows_spark": len(spark_pdf), "rows_oracle": len(oracle_pdf),
           "cols_match": sorted(spark_pdf.columns) == sorted(oracle_pdf.columns)}
    out["rows_match"] = out["rows_spark"] == out["rows_oracle"]
    if out["cols_match"] and out["rows_match"]:
        a, b = _canon(spark_pdf), _canon(oracle_pdf)
        diff = (a.fillna("<null>") != b.fillna("<null>"))
        out["values_match"] = not bool(diff.to_numpy().any())
        if not out["values_match"]:
            bad = diff.sum(axis=0)
            out["bad_columns"] = {c: int(bad[c]) for c in a.columns if bad[c]}
            i = int(diff.any(axis=1).to_numpy().argmax())
            out["first_bad_row"] = {"spark": a.iloc[i].to_dict(), "oracle": b.iloc[i].to_dict()}
    else:
        out["values_match"] = False
        out["spark_cols"], out["oracle_cols"] = list(spark_pdf.columns), list(oracle_pdf.columns)
    return out
