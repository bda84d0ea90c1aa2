import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.model import SeriesPanel, as_panel  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4)
    yield s


def day(i: int) -> datetime:
    return datetime(2024, 1, 1) + timedelta(days=i)


def make_panel(spark, series: dict, keys=None, unique=True, start=None) -> SeriesPanel:
    """series: code -> list of values (daily from 2024-01-01, or start[code]),
    or code -> list of (day offset, value)."""
    rows = []
    for code, vals in series.items():
        for i, v in enumerate(vals):
            if isinstance(v, tuple):
                rows.append((code, day(v[0]), v[1]))
            else:
                rows.append((code, day(i + (start or {}).get(code, 0)), v))
    df = spark.createDataFrame(rows, "code string, t timestamp_ntz, v double")
    return as_panel(df, [], "code", "t", "v", unique=unique)


def values(df, sort=True):
    pdf = df.toPandas()
    if sort:
        pdf = pdf.sort_values("obs_time", kind="mergesort")
    return [None if v != v else v for v in pdf["value"].tolist()]
