"""All registered queries of the reference's operators, each with its SQL where SQL can say it."""

from __future__ import annotations

from trivet.plans import frame_queries, mesh_queries, misc_queries, rule_queries

MODULES = (mesh_queries, frame_queries, misc_queries, rule_queries)
QUERIES = {name: run for m in MODULES for name, run in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
