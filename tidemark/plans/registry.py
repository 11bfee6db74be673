"""All registered queries."""

from __future__ import annotations

from tidemark.plans import access, governance, history, loads, organization
from tidemark.plans.query import Query

_FAMILIES = (loads, history, organization, access, governance)

QUERIES: dict[str, Query] = {}
for _family in _FAMILIES:
    for _name, _query in _family.QUERIES.items():
        if _name in QUERIES:
            raise RuntimeError(f"two queries are called {_name}")
        QUERIES[_name] = _query
