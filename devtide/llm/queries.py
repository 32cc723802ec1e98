"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import op4_bpe_codec
from .decontamination import op1_decontamination
from .importance import ORACLE as _IMPORTANCE_ORACLE
from .importance import op12_importance_resampling
from .language_id import op2_language_id
from .language_model import op10_lm_scores
from .licenses import op7_license_scan
from .ngram_join import op9_ngram_join
from .prefix_trie import ORACLE as _TRIE_ORACLE
from .prefix_trie import op11_prefix_trie
from .quality import op8_quality_rules
from .secret_scan import op3_secret_scan
from .token_counts import op13_token_counts
from .toxicity import op5_toxicity
from .warc_audit import ORACLE as _WARC_ORACLE
from .warc_audit import op6_warc_audit

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_language_id": op2_language_id,
    "op3_secret_scan": op3_secret_scan,
    "op4_bpe_codec": op4_bpe_codec,
    "op5_toxicity": op5_toxicity,
    "op6_warc_audit": op6_warc_audit,
    "op7_license_scan": op7_license_scan,
    "op8_quality_rules": op8_quality_rules,
    "op9_ngram_join": op9_ngram_join,
    "op10_lm_scores": op10_lm_scores,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_token_counts": op13_token_counts,
}

ORACLE_SQL: dict[str, str] = {
    "op6_warc_audit": _WARC_ORACLE,
    "op11_prefix_trie": _TRIE_ORACLE,
    "op12_importance_resampling": _IMPORTANCE_ORACLE,
}
