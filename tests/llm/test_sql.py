"""Registered training-data queries against their SQL twins, and the removal of the package."""

import os
import subprocess
import sys

import check_oracle as CO
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from inkwell.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not available")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    df = entry.queries()[name](spark, SF)
    cur = CO.connect(SF).execute(queries.ORACLES[name])
    assert CO.rows_of(df.columns, [tuple(r) for r in df.collect()]) == CO.rows_of([d[0] for d in cur.description], cur.fetchall())


def test_one_query_per_operator_and_the_pipeline():
    names = set(entry.queries())
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11)) and "pipeline" in names
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and corpus_pipeline.ORACLE_SQL is None


def test_the_rest_imports_without_the_package():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name in ("corpus_pipeline", "inkwell.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert "chunk_text" in e.queries() and not any(n.startswith("op") and n[2].isdigit() for n in e.queries()) and "pipeline" not in e.queries()
assert set(e.oracle_sql()) == set(e.queries())
"""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
