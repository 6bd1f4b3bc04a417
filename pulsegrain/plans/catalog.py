"""All registered queries and the SQL that gives the same results."""

from __future__ import annotations

from pulsegrain.plans import catalog_counters, catalog_documents, catalog_failures, catalog_reshape, catalog_streams

_PARTS = [catalog_documents, catalog_reshape, catalog_counters, catalog_streams, catalog_failures]

QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
SQL = {name: text for part in _PARTS for name, text in part.SQL.items()}
