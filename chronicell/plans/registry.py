"""Named queries over the driver tables and the SQL text that each is checked against."""

from __future__ import annotations

from chronicell.plans import cells, decoding, history, log, messages, resuming

QUERIES: dict = {}
ORACLE_SQL: dict = {}
for _module in (decoding, log, cells, history, resuming, messages):
    QUERIES |= {name: query for name, (query, _) in _module.PLANS.items()}
    ORACLE_SQL |= {name: sql for name, (_, sql) in _module.PLANS.items() if sql}
