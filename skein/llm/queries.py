"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from skein.llm import chat_format, decontamination, exponion, fim, license_scan, line_dedup, media, packing, quality, simhash, token_counts, token_files, toxicity


def queries() -> dict:
    return {
        "op1_license_scan": license_scan.query,
        "op2_flac_media": media.query,
        "op3_fm_decontamination": decontamination.query,
        "op4_best_fit_packing": packing.query,
        "op5_token_counts": token_counts.query,
        "op6_token_files": token_files.query,
        "op7_simhash_anchors": simhash.query,
        "op8_line_dedup": line_dedup.query,
        "op9_chat_format": chat_format.query,
        "op10_quality_classifier": quality.query,
        "op11_toxicity_lexicon": toxicity.query,
        "op12_exponion_clusters": exponion.query,
        "op13_fill_in_middle": fim.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": license_scan.oracle(),
        "op3_fm_decontamination": decontamination.ORACLE,
        "op9_chat_format": chat_format.ORACLE,
        "op12_exponion_clusters": exponion.oracle(),
        "op13_fill_in_middle": fim.ORACLE,
    }
