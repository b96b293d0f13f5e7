"""The operators of this subpackage as named queries over whole tables."""

from anchorline.llm import langid, mixing, neighbours, pieces, quality, simhash, substring_dedup, suffix_dedup, toxicity, urlfilter

QUERIES = {
    "op1_mixing": mixing.query,
    "op2_url_filters": urlfilter.query,
    "op3_language_id": langid.query,
    "op4_neighbours": neighbours.query,
    "op5_suffix_dedup": suffix_dedup.query,
    "op6_substring_dedup": substring_dedup.query,
    "op7_simhash": simhash.query,
    "op8_toxicity": toxicity.query,
    "op9_quality_rules": quality.query,
    "op10_pieces": pieces.query,
    "quality_base": quality.base_query,
    "mixing_targets": mixing.targets_query,
    "neighbours_exact": neighbours.exact_query,
}
#: DuckDB text where SQL expresses the operator; the others are tested against brute force.
ORACLE = {"op2_url_filters": urlfilter.SQL, "op5_suffix_dedup": suffix_dedup.SQL, "op6_substring_dedup": substring_dedup.SQL, "quality_base": quality.BASE_SQL, "mixing_targets": mixing.TARGETS_SQL, "neighbours_exact": neighbours.EXACT_SQL}
