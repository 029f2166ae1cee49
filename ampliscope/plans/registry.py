"""All queries of the library over the test tables, and their SQL."""

from __future__ import annotations

from ampliscope.plans import base, q_classify, q_collapse, q_dna, q_joins, q_more, q_pool  # noqa: F401


def queries() -> dict:
    return dict(base.QUERIES)


def oracle_sql() -> dict:
    return dict(base.SQL)
