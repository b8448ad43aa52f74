"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from broadloom.llm import alignment, bpe, embedding_dedup, exact_dedup, html_text, language_id, packing, quality, secrets, simhash, substring_dedup, warc, whitening

QUERIES = {
    "op1_embedding_dedup": embedding_dedup.op1_embedding_dedup,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op3_bpe": bpe.op3_bpe,
    "op4_simhash": simhash.op4_simhash,
    "op5_secrets": secrets.op5_secrets,
    "op6_packing": packing.op6_packing,
    "op7_language_id": language_id.op7_language_id,
    "op8_warc": warc.op8_warc,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_quality": quality.op10_quality,
    "op11_alignment": alignment.op11_alignment,
    "op12_html_extraction": html_text.op12_html_extraction,
    "op13_whitening": whitening.op13_whitening,
}

SQL = {**embedding_dedup.SQL, **exact_dedup.SQL, **warc.SQL}
