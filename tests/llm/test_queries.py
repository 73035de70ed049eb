"""Registered operator queries next to their SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest

pytest.importorskip("vacantia.llm")

from check import compare, connect  # noqa: E402
from vacantia.llm import queries  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query(spark, name):
    _, _, verdict = compare(spark, connect(SF_DIR), SF_DIR, name, queries.QUERIES[name], queries.ORACLES[name])
    assert verdict.startswith("ok") and "TYPES" not in verdict, verdict


def test_one_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))
