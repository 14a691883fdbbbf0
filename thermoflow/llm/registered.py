"""The registered queries of this package and their SQL counterparts."""

from __future__ import annotations

import re

from thermoflow.llm import (
    decontamination, fill_in_middle, filter_audit, line_dedup, ngram_jaccard_join, pfair_mixing, quality_lines, quality_rules, quotation_links,
    secret_scans, substring_dedup, token_counts, toxicity,
)

_MODULES = (
    quality_rules, ngram_jaccard_join, secret_scans, decontamination, token_counts, quotation_links,
    line_dedup, substring_dedup, toxicity, pfair_mixing, quality_lines, fill_in_middle, filter_audit,
)

QUERIES = {
    name: query for module in _MODULES for name, query in vars(module).items() if re.match(r"op\d+_", name)
}
ORACLES = {
    name: module.SQL for module in _MODULES if hasattr(module, "SQL") for name in QUERIES if name in vars(module)
}
