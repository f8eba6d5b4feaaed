"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

import corpus_pipeline

from . import conversation_repair, cover_dedup, exact_dedup, line_dedup, mixing, mtree, packing, pii, quality_rules, ranked_search, sharding, simhash, suffix_dedup


def queries() -> dict:
    return {
        "op1_packing": packing.op1_packing,
        "op2_exact_dedup": exact_dedup.op2_exact_dedup,
        "op3_line_dedup": line_dedup.op3_line_dedup,
        "op4_cover_dedup": cover_dedup.op4_cover_dedup,
        "op5_pii": pii.op5_pii,
        "op6_quality_rules": quality_rules.op6_quality_rules,
        "op7_sharding": sharding.op7_sharding,
        "op8_mixing": mixing.op8_mixing,
        "op9_simhash": simhash.op9_simhash,
        "op10_suffix_dedup": suffix_dedup.op10_suffix_dedup,
        "op11_mtree_search": mtree.op11_mtree_search,
        "op12_ranked_search": ranked_search.op12_ranked_search,
        "op13_conversation_repair": conversation_repair.op13_conversation_repair,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_exact_dedup": exact_dedup.OP2_SQL,
        "op3_line_dedup": line_dedup.OP3_SQL,
        "op4_cover_dedup": cover_dedup.OP4_SQL,
        "op6_quality_rules": quality_rules.OP6_SQL,
        "op7_sharding": sharding.OP7_SQL,
        "op8_mixing": mixing.OP8_SQL,
        "op11_mtree_search": mtree.OP11_SQL,
        "op12_ranked_search": ranked_search.OP12_SQL,
        "op13_conversation_repair": conversation_repair.OP13_SQL,
    }
