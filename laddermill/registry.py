"""All queries of the ranked-match operators, and their DuckDB twins."""

from __future__ import annotations

from laddermill.plans import cube, events, findings, ingest, marts, quality, sources

MODULES = (marts, events, ingest, cube, findings, quality, sources)
QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
