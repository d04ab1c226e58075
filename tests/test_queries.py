"""Every registered query against its SQL on the smallest tables, and the shape of its plan."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
import check
from helpers import plan
from velotrail.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

FOLDED = {n for n in QUERIES if n.startswith("check_and_")}


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    ok, note = check.compare(spark, con, name, SF)
    assert ok, note
    text = plan(entry.queries()[name](spark, SF)) if not name.startswith(("st_", "src_", "sink_")) else ""
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    if name not in FOLDED:
        assert "Python" not in text and "InPandas" not in text


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() == 15
