"""Training-data operators: ten single operators; nothing outside this subpackage imports it."""

from __future__ import annotations


def queries() -> dict:
    """One query for each operator, over its whole table."""
    from . import exact, langid, packing, pieces, shard, simhash, substring, tokenfiles, topk, warc

    return {
        "op1_simhash": simhash.op1_simhash,
        "op2_sharding": shard.op2_sharding,
        "op3_packing": packing.op3_packing,
        "op4_substring_dedup": substring.op4_substring_dedup,
        "op5_sentencepiece": pieces.op5_sentencepiece,
        "op6_exact_dedup": exact.op6_exact_dedup,
        "op7_language_id": langid.op7_language_id,
        "op8_token_files": tokenfiles.op8_token_files,
        "op9_topk": topk.op9_topk,
        "op10_warc": warc.op10_warc,
    }


def oracle_sql() -> dict[str, str]:
    from . import exact, substring, topk, warc

    return {
        "op4_substring_dedup": substring.ORACLE,
        "op6_exact_dedup": exact.ORACLE,
        "op9_topk": topk.ORACLE,
        "op10_warc": warc.ORACLE,
    }
