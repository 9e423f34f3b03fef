"""Queries by name, with their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from quillmap.fixtures import ELEMENTS, FIELDS_INV, WORDS_DOC, WORDS_INV, WORDS_PAGES

QUERIES: dict = {}
SQL: dict[str, str] = {}
FIXTURES = {"wd": WORDS_DOC, "wi": WORDS_INV, "fi": FIELDS_INV, "el": ELEMENTS, "wp": WORDS_PAGES}


def query(sql: str | None = None, use: str = ""):
    """Registers a query by its function's name; `use` names the fixtures that its SQL starts from."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ctes = ",\n".join(FIXTURES[u] for u in use.split())
            own = sql.strip()
            SQL[f.__name__] = f"WITH {ctes}{',' if own[:5].upper() == 'WITH ' else ''}\n{own[5:] if own[:5].upper() == 'WITH ' else own}" if ctes else own
        return f

    return add
