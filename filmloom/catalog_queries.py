"""Every catalog operator as a query over the given tables, with its SQL twin."""

from __future__ import annotations

from filmloom.plans import registry

FLAGSHIP = "j01_parent_child"


def _gathered():
    from filmloom.plans import q_composed, q_extract, q_relational, q_tables  # noqa: F401  modules register their queries

    return registry


def queries() -> dict[str, registry.Query]:
    return dict(_gathered().QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_gathered().SQL)
