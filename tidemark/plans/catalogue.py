"""All registered queries and their SQL counterparts."""

from __future__ import annotations

from tidemark.plans import cdc, ingest, profile, sales, sessions
from tidemark.plans.common import Query

AREAS = (sessions, sales, cdc, ingest, profile)


def queries() -> dict[str, Query]:
    return {name: query for area in AREAS for name, query in area.QUERIES.items()}


def oracle() -> dict[str, str]:
    return {name: sql for area in AREAS for name, sql in area.ORACLE.items()}
