"""All queries of the subpackage."""

from __future__ import annotations

from inkframe.llm import queries_groups, queries_leakage, queries_lookalikes, queries_mixing, queries_mojibake, queries_residue, queries_splitting

QUERIES, ORACLES = {}, {}
for _m in (queries_groups, queries_leakage, queries_lookalikes, queries_mixing, queries_mojibake, queries_residue, queries_splitting):
    QUERIES.update(_m.R.queries)
    ORACLES.update(_m.R.oracles)
