"""Registry of the library's queries: name -> function (spark, sf_dir), and name -> DuckDB SQL."""

from __future__ import annotations

from lexloom.plans import evidence, fixtures, service, tables  # noqa: F401 (both register with tables)

QUERIES = tables.QUERIES | fixtures.QUERIES
ORACLES = tables.ORACLES | fixtures.ORACLES
