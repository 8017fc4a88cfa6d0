"""Queries of this subpackage and their SQL where it can express them."""

from cairnspark.llm import align, bpe, chat, digest, hardneg, html, packing, pieces, quality, simhash, token_counts, toxicity, warc

QUERIES = {
    "op1_chat": chat.op1_chat,
    "op2_warc": warc.op2_warc,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_token_counts": token_counts.op4_token_counts,
    "op5_simhash": simhash.op5_simhash,
    "op6_pieces": pieces.op6_pieces,
    "op7_fingerprints": digest.op7_fingerprints,
    "op8_quality_rules": quality.op8_quality_rules,
    "op9_packing": packing.op9_packing,
    "op10_html": html.op10_html,
    "op11_hard_negatives": hardneg.op11_hard_negatives,
    "op12_bpe": bpe.op12_bpe,
    "op13_align": align.op13_align,
}

ORACLE_SQL: dict[str, str] = {
    "op1_chat": chat.ORACLE_SQL,
    "op2_warc": warc.ORACLE_SQL,
    "op11_hard_negatives": hardneg.ORACLE_SQL,
}
