"""The query catalogue: every operator applied to the public test tables, with the SQL that gives the same rows."""

from . import corpus, entities, language, records, relational, scalars

_PARTS = (relational, scalars, corpus, language, entities, records)


def queries() -> dict:
    return {name: q for part in _PARTS for name, (q, _) in part.CATALOGUE.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, (_, sql) in part.CATALOGUE.items() if sql}
