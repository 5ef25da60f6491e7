"""Registered queries of the training-data operators.

``QUERIES[name] = (builder, oracle SQL or None)``; where SQL is None the query
is tested against a brute-force version in ``tests/llm``.
"""

from __future__ import annotations

from . import best_fit, exact_dedup, line_dedup, mixing, near_dedup, neighbours, packing, periodic, pii, sharding, spelling, toxicity, warc

QUERIES = {
    "op1_toxicity": (toxicity.query, None),
    "op2_near_dedup": (near_dedup.query, None),
    "op3_exact_dedup": (exact_dedup.query, exact_dedup.SQL),
    "op4_sharding": (sharding.query, None),
    "op5_pii": (pii.query, None),
    "op6_line_dedup": (line_dedup.query, line_dedup.SQL),
    "op7_packing": (packing.query, None),
    "op8_mixing": (mixing.query, None),
    "op9_neighbours": (neighbours.query, None),
    "op10_warc": (warc.query, None),
    "op11_spelling_variants": (spelling.query, None),
    "op12_periodic_runs": (periodic.query, None),
    "op13_best_fit": (best_fit.query, None),
}
