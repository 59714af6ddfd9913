"""DuckDB oracles: the same relations and results, stated independently in SQL."""

import re

from shelfwise.oracle.base_sql import AS_OF, BASE_CTES
from shelfwise.sources.adapter import duckdb_relations

_NAME = re.compile(r"[a-z_][a-z0-9_]*")


def _uses(text: str) -> list[str]:
    """Identifiers of a statement, with repetitions; string literals do not count."""
    return _NAME.findall(re.sub(r"'[^']*'", "''", text))


def compose(final_sql: str, extra_ctes: list[tuple[str, str]] | None = None) -> str:
    """Full DuckDB statement: the relations that ``final_sql`` needs, directly or not, and itself.

    A relation that is read more than once is materialized.
    """
    parts = [*duckdb_relations(), *BASE_CTES, *(extra_ctes or [])]
    reads = {name: 0 for name, _ in parts}
    for word in _uses(final_sql):
        if word in reads:
            reads[word] += 1
    for name, text in reversed(parts):  # a relation reads earlier ones only
        if reads[name]:
            for word in _uses(text):
                if word in reads and word != name:
                    reads[word] += 1
    ctes = [f"{name} AS {'MATERIALIZED ' if reads[name] > 1 else ''}({text.strip()}\n)"
            for name, text in parts if reads[name]]
    final_sql = final_sql.strip()
    if not ctes:
        return final_sql
    if final_sql[:4].upper() == "WITH":
        # the statement's own CTEs continue the list
        return "WITH " + ",\n".join(ctes) + ",\n" + final_sql[4:].lstrip()
    return "WITH " + ",\n".join(ctes) + "\n" + final_sql


__all__ = ["AS_OF", "compose"]
