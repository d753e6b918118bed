"""Queries and SQL of this package."""

from __future__ import annotations

from tessera.llm import abuse, leakage, markup, mixing, neardup, oracles, ranking, splitting, subset, vectors

QUERIES = {
    "p1_found": vectors.p1_found,
    "p1_neighbours": vectors.p1_neighbours,
    "p2_found": neardup.p2_found,
    "p2_groups": neardup.p2_groups,
    "p3_found": splitting.p3_found,
    "p3_pieces": splitting.p3_pieces,
    "p5_found": ranking.p5_found,
    "p5_ranking": ranking.p5_ranking,
    "p6_found": markup.p6_found,
    "p6_clean": markup.p6_clean,
    "p7_found": vectors.p7_found,
    "p7_subset": subset.p7_subset,
    "p8_found": leakage.p8_found,
    "p8_leaks": leakage.p8_leaks,
    "p9_mixture": mixing.p9_mixture,
    "p9_shares": mixing.p9_shares,
    "p10_found": abuse.p10_found,
    "p10_scores": abuse.p10_scores,
    "p10_rates": abuse.p10_rates,
}
SQL = {
    "p1_found": oracles.P1_FOUND,
    "p1_neighbours": oracles.P1_NEIGHBOURS,
    "p2_found": oracles.P2_FOUND,
    "p2_groups": oracles.P2_GROUPS,
    "p3_found": splitting.P3_SQL,
    "p5_found": ranking.P5_SQL,
    "p5_ranking": oracles.P5_RANKING,
    "p7_found": oracles.P7_FOUND,
    "p8_found": oracles.P8_FOUND,
}
