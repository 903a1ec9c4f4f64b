"""The queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from brandpulse.llm import op01_winnow, op02_toxic, op03_vbyte, op04_substring, op05_chat, op06_interleave, op07_quality, op08_pack, op09_mix, op10_jaccard, op11_leaks, op12_variants, op13_align

QUERIES = {
    "op1_fingerprints": op01_winnow.op1_fingerprints,
    "op2_toxicity": op02_toxic.op2_toxicity,
    "op3_token_output": op03_vbyte.op3_token_output,
    "op4_substring": op04_substring.op4_substring,
    "op5_chat": op05_chat.op5_chat,
    "op6_sharding": op06_interleave.op6_sharding,
    "op7_quality": op07_quality.op7_quality,
    "op8_packing": op08_pack.op8_packing,
    "op9_mixing": op09_mix.op9_mixing,
    "op10_ngram_join": op10_jaccard.op10_ngram_join,
    "op11_decontamination": op11_leaks.op11_decontamination,
    "op12_variants": op12_variants.op12_variants,
    "op13_alignment": op13_align.op13_alignment,
}

SQL = {
    "op4_substring": op04_substring.OP4_SQL,
    "op5_chat": op05_chat.OP5_SQL,
    "op7_quality": op07_quality.OP7_SQL,
    "op9_mixing": op09_mix.OP9_SQL,
    "op11_decontamination": op11_leaks.OP11_SQL,
}
