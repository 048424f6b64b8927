"""Every registered query against its SQL twin on the smallest data set."""

import os

import pytest

import __spark_entry__ as entry
import check_oracle as CO
from inkwell.plans import catalog, oracle

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not available")


@pytest.fixture(scope="module")
def con():
    return CO.connect(SF)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_a_twin():
    # byte pairs are not SQL: test_tokens holds these chunks against the tokenizer
    assert set(catalog.QUERIES) - {"chunk_tokens"} == set(oracle.ORACLES)
    assert set(oracle.ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(oracle.ORACLES))
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got = CO.rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(entry.oracle_sql()[name])
    want = CO.rows_of([d[0] for d in cur.description], cur.fetchall())
    assert got == want
