"""The registered queries of the subpackage, and SQL where it can express one."""

from aerolith.llm import collapse, decontam, gbt, gru, lm, masks, mixing, pii, pivots, pu, simhash, superkmer, tokens

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_quality_rules": gbt.op2_quality_rules,
    "op3_mixing": mixing.op3_mixing,
    "op4_decontaminate": decontam.op4_decontaminate,
    "op5_substring_dedup": superkmer.op5_substring_dedup,
    "op6_tokens": tokens.op6_tokens,
    "op7_lm": lm.op7_lm,
    "op8_simhash": simhash.op8_simhash,
    "op9_language": gru.op9_language,
    "op10_quality": pu.op10_quality,
    "op11_pivot_search": pivots.op11_pivot_search,
    "op12_mask_search": masks.op12_mask_search,
    "op13_prefix_trie": collapse.op13_prefix_trie,
}
ORACLE = {
    "op3_mixing": mixing.MIX_SQL,
    "op4_decontaminate": decontam.ORACLE_SQL,
    "op5_substring_dedup": superkmer.ORACLE_SQL,
    "op11_pivot_search": pivots.ORACLE_SQL,
    "op12_mask_search": masks.ORACLE_SQL,
    "op13_prefix_trie": collapse.ORACLE_SQL,
}
