"""What several test files need; a module of its own, since every folder may have a ``conftest``."""

from __future__ import annotations

import os

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)
