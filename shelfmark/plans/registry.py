"""All registered queries by name."""

from __future__ import annotations

from shelfmark.plans import content, lookups, searches, upkeep

MODULES = (searches, lookups, content, upkeep)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in MODULES for name, sql in module.SQL.items()}
