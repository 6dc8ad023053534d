"""Every operator as a query over the driver's tables, with its SQL."""

from catalog import documents, facts, links, raw, stores

_MODULES = (raw, facts, documents, links, stores)


def all_queries():
    return {name: run for module in _MODULES for name, run in module.QUERIES.items()}


def all_sql():
    return {name: sql for module in _MODULES for name, sql in module.SQL.items()}
