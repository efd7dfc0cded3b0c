"""Queries against their SQL, on real tables and on edge cases."""

from pathlib import Path

import pytest
from conftest import SF

from compare import connect, mismatch
from tidemark.llm.oracles import ORACLES
from tidemark.llm.queries import QUERIES


@pytest.mark.parametrize("kind", ["real", "edge"])
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(request, spark, name, kind):
    sf_dir = SF if kind == "real" else request.getfixturevalue("edge_dir")
    con = connect(Path(sf_dir))
    try:
        assert mismatch(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None
    finally:
        con.close()
