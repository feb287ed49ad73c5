import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql.types import _parse_datatype_string  # noqa: E402

from tallybook.sources.model import InvoiceModel  # noqa: E402
from tests.schemas import DDL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]").appName("tallybook-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


def D(x) -> Decimal:
    return Decimal(str(x))


def table(spark, name, rows, ddl=None):
    """A DataFrame of ``rows`` (dicts; missing columns are NULL) typed as ``name``."""
    schema = _parse_datatype_string(ddl or DDL[name])
    cols = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], schema)


def model(spark, **tables) -> InvoiceModel:
    """An invoice model from hand-built rows; tables not given are empty.
    A value may be a list of dicts or a ready DataFrame."""
    dfs = {}
    for name in DDL:
        v = tables.pop(name, [])
        dfs[name] = v if hasattr(v, "schema") else table(spark, name, v)
    assert not tables, f"unknown tables {list(tables)}"
    return InvoiceModel(**dfs).check()


@pytest.fixture
def mk(spark):
    return lambda **t: model(spark, **t)
