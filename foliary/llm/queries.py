"""The queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from foliary.llm import decontaminate, html_text, infill, language, licenses, near_duplicates, packing, phrases, quality, secrets, token_counts, warc, wavelet

QUERIES = {
    "op1_best_fit": packing.op1_best_fit,
    "op2_language": language.op2_language,
    "op3_html_text": html_text.op3_html_text,
    "op4_licenses": licenses.op4_licenses,
    "op5_token_shards": wavelet.op5_token_shards,
    "op6_token_counts": token_counts.op6_token_counts,
    "op7_ngram_jaccard": near_duplicates.op7_ngram_jaccard,
    "op8_secrets": secrets.op8_secrets,
    "op9_decontamination": decontaminate.op9_decontamination,
    "op10_quality": quality.op10_quality,
    "op11_warc": warc.op11_warc,
    "op12_collocations": phrases.op12_collocations,
    "op13_fill_in_middle": infill.op13_fill_in_middle,
}
ORACLES = {
    "op7_ngram_jaccard": near_duplicates.OP7_SQL,
    "op8_secrets": secrets.OP8_SQL,
    "op9_decontamination": decontaminate.OP9_SQL,
    "op10_quality": quality.OP10_SQL,
    "op11_warc": warc.OP11_SQL,
    "op12_collocations": phrases.OP12_SQL,
    "op13_fill_in_middle": infill.OP13_SQL,
}
