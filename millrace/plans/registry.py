"""Registered queries of the core and their SQL counterparts."""

from __future__ import annotations

from millrace.plans import activity_queries, sense_queries, text_queries

_MODULES = (text_queries, sense_queries, activity_queries)
QUERIES: dict = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
ORACLE: dict = {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
