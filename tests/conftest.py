from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from dxcohort.schemas import ADMISSIONS, DENOM  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="dxcohort-wh-"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def adm_rows(spark, rows):
    """Admissions from (bene, adm, date, year, diagnoses[, discharge])."""
    full = []
    for r in rows:
        bene, adm, date, year, dx = r[:5]
        dis = r[5] if len(r) > 5 else date
        full.append((bene, adm, d(date) if date else None, d(dis) if dis else None, year, "src", dx))
    return spark.createDataFrame(full, ADMISSIONS)


def denom_rows(spark, rows):
    return spark.createDataFrame(rows, DENOM)


def collect_set(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
