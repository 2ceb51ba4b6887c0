"""Queries of the operators in this package, and their SQL where SQL can express them."""

from feira.llm import (
    bpe,
    chat,
    compress_score,
    exact_dedup,
    fingerprints,
    lexical_search,
    line_dedup,
    mixing,
    periodic_runs,
    quality_rules,
    simhash,
    suffix_dedup,
    token_files,
)

QUERIES = {
    "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
    "op4_chat": chat.op4_chat,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_compression_score": compress_score.op9_compression_score,
    "op10_token_files": token_files.op10_token_files,
    "op1_bpe": bpe.op1_bpe,
    "op3_simhash": simhash.op3_simhash,
    "op7_mixing": mixing.op7_mixing,
    "op5_quality_rules": quality_rules.op5_quality_rules,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op11_lexical_search": lexical_search.op11_lexical_search,
    "op12_fingerprints": fingerprints.op12_fingerprints,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}

ORACLE_SQL = {
    "op2_suffix_dedup": suffix_dedup.OP2_SQL,
    "op4_chat": chat.OP4_SQL,
    "op8_line_dedup": line_dedup.OP8_SQL,
    "op6_exact_dedup": exact_dedup.OP6_SQL,
    "op11_lexical_search": lexical_search.OP11_SQL,
}
