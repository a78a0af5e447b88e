"""Queries by name, and the SQL that some are checked against."""

from __future__ import annotations

from runtrace.llm import queries, sql

QUERIES = {name: run for name, run in vars(queries).items() if name.startswith("op") and name[2].isdigit()}
SQL = sql.SQL
