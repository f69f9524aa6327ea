"""Training-data operators: scoring, filtering, deduplication, sharding, packing and chat repair.

Nothing outside this package imports it. ``tidemark.llm.catalog`` holds the
registered queries, ``tidemark.llm.oracles`` their DuckDB statements.
"""
