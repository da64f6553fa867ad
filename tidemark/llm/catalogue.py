"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from tidemark.llm import exact_search, hard_negatives, secret_scans
from tidemark.llm.byte_bpe import op4_byte_bpe
from tidemark.llm.chat_format import op10_chat_format
from tidemark.llm.exact_search import op6_exact_search
from tidemark.llm.forest_search import op2_forest_search
from tidemark.llm.hard_negatives import op11_hard_negatives
from tidemark.llm.language_id import op9_language_id
from tidemark.llm.minhash import op7_minhash_dedup
from tidemark.llm.packing import op1_best_fit_packing
from tidemark.llm.secret_scans import op8_secret_scans
from tidemark.llm.spelling import op13_spelling_variants
from tidemark.llm.suffix_dedup import op3_suffix_dedup
from tidemark.llm.token_counts import op5_token_counts
from tidemark.llm.toxicity import op12_toxicity

_ALL = (
    op1_best_fit_packing,
    op2_forest_search,
    op3_suffix_dedup,
    op4_byte_bpe,
    op5_token_counts,
    op6_exact_search,
    op7_minhash_dedup,
    op8_secret_scans,
    op9_language_id,
    op10_chat_format,
    op11_hard_negatives,
    op12_toxicity,
    op13_spelling_variants,
)

QUERIES = {f.__name__: f for f in _ALL}

ORACLES: dict[str, str] = {
    "op6_exact_search": exact_search.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op8_secret_scans": secret_scans.oracle(),
}
