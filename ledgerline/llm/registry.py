"""The registered queries of this subpackage and their SQL."""

from ledgerline.llm import (byte_bpe, exact_dedup, lattice, lexical, licenses, minhash, mixing, pii, piece_bpe,
                            quality, substrings, token_counts, tries)

LLM_QUERIES = {
    "op1_lattice": lattice.op1_lattice,
    "op2_substrings": substrings.op2_substrings,
    "op3_license_scan": licenses.op3_license_scan,
    "op4_token_counts": token_counts.op4_token_counts,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_quality": quality.op6_quality,
    "op7_pii": pii.op7_pii,
    "op8_source_mix": mixing.op8_source_mix,
    "op9_byte_bpe": byte_bpe.op9_byte_bpe,
    "op10_minhash": minhash.op10_minhash,
    "op11_piece_bpe": piece_bpe.op11_piece_bpe,
    "op12_best_position": lexical.op12_best_position,
    "op13_prefix_trie": tries.op13_prefix_trie,
}

LLM_ORACLE = {
    "op5_exact_dedup": exact_dedup.OP5_SQL,
    "op8_source_mix": mixing.OP8_SQL,
    "op12_best_position": lexical.OP12_SQL,
    "op13_prefix_trie": tries.OP13_SQL,
}
