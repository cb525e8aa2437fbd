"""Named queries over the given tables, each with the SQL that must give the same rows where SQL can say it."""

from importlib import import_module

MODULES = ["tables", "records", "tags", "filters", "joins", "sampling", "stats", "windows", "scalars", "text", "waveforms", "streams"]


def load():
    """(queries, oracle SQL) of all modules."""
    queries, oracle = {}, {}
    for name in MODULES:
        module = import_module(f"speechframe.catalog.{name}")
        queries.update(module.CATALOG.queries)
        oracle.update(module.CATALOG.oracle)
    return queries, oracle
