"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from . import decontaminate, extraction, jaccard, lines, mixing, periodic, phrases, prefix_bpe, quality, rollups, substrings, token_files, urls

QUERIES = {
    "op1_line_dedup": lines.query,
    "op2_quality_rules": quality.query,
    "op3_mix_sources": mixing.query,
    "op4_ngram_jaccard": jaccard.query,
    "op5_url_filter": urls.query,
    "op6_html_text": extraction.query,
    "op7_token_files": token_files.query,
    "op8_decontaminate": decontaminate.query,
    "op9_token_counts": rollups.query,
    "op10_substring_dedup": substrings.query,
    "op11_phrase_collocations": phrases.query,
    "op12_prefix_bpe": prefix_bpe.query,
    "op13_periodic_runs": periodic.query,
}

# Random cuts, a trained field, token ids, template slots and periodic runs are
# beyond SQL; tests/llm holds them against brute force.
ORACLES = {
    "op1_line_dedup": lines.oracle(),
    "op2_quality_rules": quality.oracle(),
    "op4_ngram_jaccard": jaccard.oracle(),
    "op5_url_filter": urls.oracle(),
    "op9_token_counts": rollups.oracle(),
    "op10_substring_dedup": substrings.oracle(),
    "op11_phrase_collocations": phrases.oracle(),
}
