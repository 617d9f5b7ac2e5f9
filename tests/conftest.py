from __future__ import annotations

import os
import sys
from pathlib import Path

import pandas as pd
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tessera.session import session

    base = tmp_path_factory.mktemp("spark")
    s = session("tests", "local[4]", 4, **{"spark.ui.enabled": "false", "spark.driver.memory": "3g", "spark.sql.warehouse.dir": str(base / "warehouse"), "spark.checkpoint.dir": str(base / "checkpoints"), "spark.local.dir": str(base / "local"), "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables():
    from tessera.plans.registry import Tables

    return lambda spark: Tables(spark, DATA)


def cell(v) -> str:
    """A value in a form that both engines give."""
    if v is None or v is pd.NA or v is pd.NaT or v != v:
        return ""
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return f"{v:.10g}"
    return str(v)


def rows_of(frame, columns) -> list[tuple[str, ...]]:
    return sorted(tuple(cell(v) for v in r) for r in frame[list(columns)].astype(object).itertuples(index=False))


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con
