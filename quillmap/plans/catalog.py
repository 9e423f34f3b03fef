"""All queries of the reference's operators."""

from __future__ import annotations

from quillmap.plans import q_elements, q_layout, q_matching, q_pipelines, registry  # noqa: F401


def queries() -> dict:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.SQL)
