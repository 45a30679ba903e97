"""The numbered queries and their SQL."""

from . import divergence, identifiers, language, lines, mixing, near_copies, negatives, passages, pieces, repetition, scoring, token_counts, topk

QUERIES = {
    "op5_scoring": scoring.op5_scoring,
    "op10_lines": lines.op10_lines,
    "op3_near_copies": near_copies.op3_near_copies,
    "op7_passages": passages.op7_passages,
    "op2_mixing": mixing.op2_mixing,
    "op6_topk": topk.op6_topk,
    "op4_language": language.op4_language,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_sentencepiece": pieces.op9_sentencepiece,
    "op1_repetition": repetition.op1_repetition,
    "op11_negatives": negatives.op11_negatives,
    "op12_identifiers": identifiers.op12_identifiers,
    "op13_divergence": divergence.op13_divergence,
}

ORACLES = {
    "op7_passages": passages.ORACLE,
    "op2_mixing": mixing.ORACLE,
    "op6_topk": topk.ORACLE,
    "op1_repetition": repetition.ORACLE,
    "op11_negatives": negatives.ORACLE,
    "op13_divergence": divergence.ORACLE,
}
