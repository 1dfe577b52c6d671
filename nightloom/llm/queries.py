"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import audio, decontaminate, htmltext, langid, lm, merkle, mixing, neardups, periods, substrings, tokens, topk, urls


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontaminate": decontaminate.op1_decontaminate,
        "op2_language_id": langid.op2_language_id,
        "op3_url_rules": urls.op3_url_rules,
        "op4_main_text": htmltext.op4_main_text,
        "op5_mix_sources": mixing.op5_mix_sources,
        "op6_substring_dedup": substrings.op6_substring_dedup,
        "op7_near_duplicates": neardups.op7_near_duplicates,
        "op8_katz_scores": lm.op8_katz_scores,
        "op9_mpeg_audio": audio.op9_mpeg_audio,
        "op10_token_counts": tokens.op10_token_counts,
        "op11_top_matches": topk.op11_top_matches,
        "op12_periodic_runs": periods.op12_periodic_runs,
        "op13_merkle_manifest": merkle.op13_merkle_manifest,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_url_rules": urls.OP3_SQL, "op6_substring_dedup": substrings.OP6_SQL, "op7_near_duplicates": neardups.OP7_SQL, "op8_katz_scores": lm.OP8_SQL, "op11_top_matches": topk.OP11_SQL, "op13_merkle_manifest": merkle.OP13_SQL}
