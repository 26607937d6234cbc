from __future__ import annotations

import os
import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
DATA = Path(os.environ.get("PLANQUILL_DATA", "/root/testdata"))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", "file://" + str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small() -> str:
    return str(DATA / "sf0.001")


@pytest.fixture(scope="session")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


def rows_of(frame) -> list[tuple]:
    """Rows of a pandas frame in one order, columns by name, values comparable between engines."""
    import pandas as pd

    def plain(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
            return None
        if isinstance(v, (bool, str, bytes)):
            return v
        if isinstance(v, float):
            return int(v) if v.is_integer() else float(f"{v:.9g}")
        if hasattr(v, "item"):
            return plain(v.item())
        if hasattr(v, "isoformat"):
            return str(pd.Timestamp(v))
        if isinstance(v, (list, tuple)) or hasattr(v, "tolist"):
            return tuple(plain(x) for x in v)
        return float(v) if hasattr(v, "as_integer_ratio") and not isinstance(v, int) else v

    columns = sorted(frame.columns)
    out = [tuple(plain(v) for v in r) for r in frame[columns].astype(object).itertuples(index=False)]
    return sorted(out, key=lambda r: tuple((x is not None, str(type(x)), x) if x is None or not isinstance(x, (int, float)) else (True, "n", x) for x in r))
