"""Queries of the operators, one per operator, and their SQL twins."""

from __future__ import annotations

from ebbtide.llm import ann, bpe, chat_format, collocations, decontaminate, fingerprints, hard_negatives, language_id, license_scan, ngram_join, toxicity, url_rules, warc

QUERIES = {
    "op1_language_id": language_id.query,
    "op2_chat_format": chat_format.query,
    "op3_toxicity": toxicity.query,
    "op4_decontamination": decontaminate.query,
    "op5_ann_pstable": ann.query,
    "op6_url_rules": url_rules.query,
    "op7_license_scan": license_scan.query,
    "op8_warc": warc.query,
    "op9_byte_bpe": bpe.query,
    "op10_ngram_join": ngram_join.query,
    "op11_fingerprints": fingerprints.query,
    "op12_collocations": collocations.query,
    "op13_hard_negatives": hard_negatives.query,
}

SQL = {
    "op2_chat_format": chat_format.sql(),
    "op4_decontamination": decontaminate.SQL,
    "op8_warc": warc.SQL,
    "op10_ngram_join": ngram_join.SQL,
    "op12_collocations": collocations.SQL,
    "op13_hard_negatives": hard_negatives.SQL,
}
