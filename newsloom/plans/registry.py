"""Query registry of the core: name -> callable(spark, sf_dir), and the SQL each is held against."""

from __future__ import annotations

from newsloom.plans import archive_queries, language_queries, packed_queries, record_queries, relational_queries, state_queries, stream_queries, text_queries

MODULES = [packed_queries, record_queries, relational_queries, state_queries, text_queries, language_queries, archive_queries, stream_queries]


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.ORACLE.items()}
