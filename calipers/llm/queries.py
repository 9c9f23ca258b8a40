"""The registered queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from calipers.llm import bpe, decontaminate, embedding_whitening, filter_audit, gru_lm, html_text, license_scan, line_templates, ngram_join, quality_crf, quality_rules, simhash_golay, url_filter

QUERIES = {
    "op1_bpe": bpe.op1_bpe,
    "op2_html_text": html_text.op2_html_text,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_ngram_join": ngram_join.op4_ngram_join,
    "op5_quality_crf": quality_crf.op5_quality_crf,
    "op6_line_templates": line_templates.op6_line_templates,
    "op7_license_scan": license_scan.op7_license_scan,
    "op8_quality_rules": quality_rules.op8_quality_rules,
    "op9_gru_lm": gru_lm.op9_gru_lm,
    "op10_url_filter": url_filter.op10_url_filter,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_embedding_whitening": embedding_whitening.op12_embedding_whitening,
    "op13_simhash_golay": simhash_golay.op13_simhash_golay,
}
ORACLES = {
    "op3_decontaminate": decontaminate.ORACLE_SQL,
    "op6_line_templates": line_templates.ORACLE_SQL,
    "op7_license_scan": license_scan.ORACLE_SQL,
    "op8_quality_rules": quality_rules.ORACLE_SQL,
    "op10_url_filter": url_filter.ORACLE_SQL,
    "op11_filter_audit": filter_audit.ORACLE_SQL,
}
