"""Registered queries of the text operators, and SQL where SQL can say it."""

from __future__ import annotations

from .decontamination import op7_decontamination
from .language_id import op2_language_id
from .merkle import op12_merkle_manifest
from .mixing import op3_mixing
from .oracle import SQL
from .quality_classifier import op5_quality_classifier
from .quality_rules import op6_quality_rules
from .secret_scan import op11_secret_scan
from .simhash import op4_simhash
from .substring_dedup import op1_substring_dedup
from .token_counts import op10_token_counts
from .token_output import op9_token_output
from .toxicity import op8_toxicity
from .whitening import op13_embedding_whitening

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_language_id": op2_language_id,
    "op3_mixing": op3_mixing,
    "op4_simhash": op4_simhash,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_quality_rules": op6_quality_rules,
    "op7_decontamination": op7_decontamination,
    "op8_toxicity": op8_toxicity,
    "op9_token_output": op9_token_output,
    "op10_token_counts": op10_token_counts,
    "op11_secret_scan": op11_secret_scan,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_embedding_whitening": op13_embedding_whitening,
}

__all__ = ["QUERIES", "SQL"]
