"""Registered queries of the emission engine, with the SQL that says what each returns."""

from __future__ import annotations

from .plans import queries_rasters, queries_scenes, queries_sites

_ALL = (queries_sites, queries_scenes, queries_rasters)
QUERIES = {name: f for part in _ALL for name, f in part.QUERIES.items()}
ORACLE_SQL = {name: s for part in _ALL for name, s in part.ORACLE_SQL.items()}
