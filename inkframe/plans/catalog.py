"""All queries of the core."""

from __future__ import annotations

from inkframe.plans import queries_events, queries_hierarchy, queries_index, queries_references, queries_signals, queries_story, queries_text

QUERIES, ORACLES = {}, {}
for _m in (queries_events, queries_hierarchy, queries_index, queries_references, queries_signals, queries_story, queries_text):
    QUERIES.update(_m.R.queries)
    ORACLES.update(_m.R.oracles)
