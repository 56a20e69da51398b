"""Queries of the subpackage and their SQL."""

from __future__ import annotations

from . import bpe, centroids, chat, jaccard, licenses, mixing, nearest, negatives, quality, sentencepiece, sharding, toxicity, warc


def queries() -> dict:
    return {
        "op1_ngram_jaccard_join": jaccard.op1_ngram_jaccard_join,
        "op2_sentencepiece": sentencepiece.op2_sentencepiece,
        "op3_quality_rules": quality.op3_quality_rules,
        "op4_nearest_neighbours": nearest.op4_nearest_neighbours,
        "op5_sharding": sharding.op5_sharding,
        "op6_mixing": mixing.op6_mixing,
        "op7_toxicity": toxicity.op7_toxicity,
        "op8_chat_rotation": chat.op8_chat_rotation,
        "op9_warc": warc.op9_warc,
        "op10_license_scan": licenses.op10_license_scan,
        "op11_centroid_clustering": centroids.op11_centroid_clustering,
        "op12_bpe": bpe.op12_bpe,
        "op13_hard_negatives": negatives.op13_hard_negatives,
    }


def oracle_sql() -> dict:
    return {"op3_quality_rules": quality.ORACLE, "op6_mixing": mixing.ORACLE, "op8_chat_rotation": chat.ORACLE, "op11_centroid_clustering": centroids.ORACLE, "op13_hard_negatives": negatives.ORACLE}
