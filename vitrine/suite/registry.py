"""All registered queries and their oracles."""

from __future__ import annotations

from . import catalog, cleaning, incremental, learning, mining, normalizing

MODULES = [cleaning, normalizing, catalog, mining, learning, incremental]

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
