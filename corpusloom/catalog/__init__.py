"""The registered queries over the given tables, each with its SQL equivalent where SQL has one."""

from __future__ import annotations

from importlib import import_module

from corpusloom.catalog.registry import QUERIES, SQL

for _name in ("text", "corpora", "ordering", "scoring", "runs", "sequences", "vocabulary", "vectors", "streams"):
    import_module(f"corpusloom.catalog.{_name}")

__all__ = ["QUERIES", "SQL"]
