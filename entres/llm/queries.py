"""Queries of the training-data operators, by registered name."""

from __future__ import annotations

from . import decontaminate, langid, licenses, lm_score, media, minhash, pieces, quality, substring, warc

QUERIES = {
    "op1_lm_scoring": lm_score.query,
    "op2_media_columns": media.query,
    "op3_warc": warc.query,
    "op4_quality_classifier": quality.query,
    "op5_language_id": langid.query,
    "op6_benchmark_decontamination": decontaminate.query,
    "op7_minhash_near_dedup": minhash.query,
    "op8_substring_dedup": substring.query,
    "op9_license_scans": licenses.query,
    "op10_sentencepiece": pieces.query,
}

ORACLE_SQL = {"op3_warc": warc.ORACLE_SQL}
