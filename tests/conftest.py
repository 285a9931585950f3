import datetime
import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barloom.session import tune  # noqa: E402

BAR_DDL = "symbol string, dt date, open double, high double, low double, close double, volume bigint"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return tune(session)


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-")


def day(text):
    return datetime.date.fromisoformat(text)


def bar(symbol, dt, price, volume=100, seq=None):
    """A bar with the four prices around one price."""
    prices = price if isinstance(price, tuple) else (price, price + 1.0, price - 1.0, price + 0.5)
    row = (symbol, day(dt) if dt else None, *[float(p) for p in prices], volume)
    return row if seq is None else (*row, seq)


def bars(spark, rows, seq=True):
    return spark.createDataFrame(rows, BAR_DDL + (", seq bigint" if seq else ""))


def rows(df, *columns):
    """The rows as sorted tuples, dates as text."""
    picked = df.select(*columns) if columns else df
    text = lambda v: v.isoformat() if isinstance(v, datetime.date) else v
    return sorted((tuple(text(v) for v in r) for r in picked.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


__all__ = ["bar", "bars", "day", "plan", "rows"]
