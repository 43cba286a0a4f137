"""The queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

from foliate.llm import direct_codes, html_text, language, line_dedup, near_dedup, ogg, oracles, packing, pieces_fst, repeats, rules

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_rules": rules.op2_rules,
    "op3_html_text": html_text.op3_html_text,
    "op4_near_dedup": near_dedup.op4_near_dedup,
    "op5_pieces_fst": pieces_fst.op5_pieces_fst,
    "op6_repeats": repeats.op6_repeats,
    "op7_language": language.op7_language,
    "op8_ogg": ogg.op8_ogg,
    "op9_direct_codes": direct_codes.op9_direct_codes,
    "op10_line_dedup": line_dedup.op10_line_dedup,
}

ORACLES: dict[str, str] = dict(oracles.ORACLES)
