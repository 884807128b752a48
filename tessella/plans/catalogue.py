"""Registered queries over the driver's tables, each with its DuckDB counterpart where SQL can express it."""

from __future__ import annotations

from tessella.plans import geometry_plans, ledger_plans, locate_plans, map_plans, mention_plans, place_plans, projection_plans, record_plans, state_plans, stats_plans, stream_plans, text_plans, validity_plans

_ALL = {**map_plans.QUERIES, **state_plans.QUERIES, **text_plans.QUERIES, **place_plans.QUERIES, **stats_plans.QUERIES, **record_plans.QUERIES, **stream_plans.QUERIES, **validity_plans.QUERIES, **ledger_plans.QUERIES, **projection_plans.QUERIES, **mention_plans.QUERIES, **geometry_plans.QUERIES, **locate_plans.QUERIES}
QUERIES = {name: query for name, (query, _) in _ALL.items()}
SQL = {name: sql for name, (_, sql) in _ALL.items() if sql}
