"""All queries of the core, by name."""

from __future__ import annotations

from debtloom.plans import desk_queries, drift_queries, listing_queries, roll_queries, snapshot_queries, state_queries, stream_queries

_MODULES = [roll_queries, state_queries, listing_queries, desk_queries, snapshot_queries, drift_queries, stream_queries]


def flagship(spark, sf_dir):
    return roll_queries.prospect_rollup(spark, sf_dir)


def queries() -> dict:
    return {k: f for m in _MODULES for k, f in m.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _MODULES for k, s in m.oracle_sql().items()}
