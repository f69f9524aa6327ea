"""Query catalogue: key -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver tables (through the fixture mapping of
``tidemark.sources.fixtures``) and runs the library's operators over the
whole tables. ``tidemark.plans.oracles`` holds the matching DuckDB statement
for each key that has one. Importing this package registers every key.
"""

from tidemark.plans.catalog import checks, extraction, maintenance, reports, runs, secrets, watermarks  # noqa: F401
from tidemark.plans.catalog.common import CFG, QUERIES, SPECS, _sources, query
from tidemark.plans.catalog.checks import DQ_DECLARATIONS

__all__ = ["CFG", "QUERIES", "SPECS", "DQ_DECLARATIONS", "query", "_sources"]
