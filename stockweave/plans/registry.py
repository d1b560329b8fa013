"""All registered queries and their SQL counterparts."""

from __future__ import annotations

from functools import wraps

from stockweave.plans import audit, checkout, cleaning, files, imports, rules, sales, stored, upkeep
from stockweave.session import tune

MODULES = (sales, cleaning, imports, upkeep, checkout, audit, files, rules, stored)


def _tuned(query):
    @wraps(query)
    def run(spark, sf_dir):
        return query(tune(spark), sf_dir)

    return run


def queries() -> dict:
    return {name: _tuned(query) for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for module in MODULES for name, text in module.ORACLE.items()}
