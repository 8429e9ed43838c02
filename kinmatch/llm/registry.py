"""The queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

from . import chat, html_main, language, matroska, mixing, near_dup, packing, quality_model, quality_rules, sharding

QUERIES = {
    "op1_hashed_ftrl": quality_model.op1_hashed_ftrl,
    "op2_rule_ledger": quality_rules.op2_rule_ledger,
    "op3_interleave": sharding.op3_interleave,
    "op4_matroska": matroska.op4_matroska,
    "op5_output_codes": language.op5_output_codes,
    "op6_equivalence_classes": html_main.op6_equivalence_classes,
    "op7_pivot_simhash": near_dup.op7_pivot_simhash,
    "op8_systematic_mix": mixing.op8_systematic_mix,
    "op9_bounded_space": packing.op9_bounded_space,
    "op10_budgeted_windows": chat.op10_budgeted_windows,
}

#: The others can't be expressed in SQL: tests hold them against brute force.
SQL = {
    "op2_rule_ledger": quality_rules.OP2_SQL,
    "op3_interleave": sharding.OP3_SQL,
    "op8_systematic_mix": mixing.OP8_SQL,
    "op10_budgeted_windows": chat.OP10_SQL,
}
