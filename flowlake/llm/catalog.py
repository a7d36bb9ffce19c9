"""All queries of this subpackage and their SQL twins."""

from __future__ import annotations

from flowlake.llm import queries_models, queries_overlap, queries_scan, queries_select, queries_text  # noqa: F401
from flowlake.llm.tables import ORACLES, QUERIES, QueryFn


def all_queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)
