"""Plans of the training-data queries: no row-at-a-time UDF, no pairwise join."""

from __future__ import annotations

import contextlib
import io

import pytest

from cartwheel.llm import queries
from conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_no_pairwise_join_and_no_row_udf(spark, name):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        queries.QUERIES[name](spark, SF_SMALL).explain("formatted")
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in out.getvalue(), f"{name}: {bad}"
