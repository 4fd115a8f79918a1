"""The queries of this part and the SQL that some are checked against."""

from __future__ import annotations

from webloom.llm import (
    chat_format, embedding_dedup, exact_dedup, fill_in_middle, html_text, language, mixing, near_dedup, packing, repeats, sharding, target_resampling, toxicity,
)

QUERIES = {
    "op1_language_id": language.query,
    "op2_exact_dedup": exact_dedup.query,
    "op3_repeats": repeats.query,
    "op4_packing": packing.query,
    "op5_toxicity": toxicity.query,
    "op6_near_dedup": near_dedup.query,
    "op7_embedding_dedup": embedding_dedup.query,
    "op8_mixing": mixing.query,
    "op9_html_text": html_text.query,
    "op10_sharding": sharding.query,
    "op11_chat_format": chat_format.query,
    "op12_target_resampling": target_resampling.query,
    "op13_fill_in_middle": fill_in_middle.query,
}

ORACLES = {
    "op2_exact_dedup": exact_dedup.SQL,
    "op8_mixing": mixing.SQL,
    "op11_chat_format": chat_format.SQL,
    "op12_target_resampling": target_resampling.SQL,
    "op13_fill_in_middle": fill_in_middle.SQL,
}
