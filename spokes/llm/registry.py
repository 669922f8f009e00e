"""The operators' queries and, where SQL can say it, their DuckDB twins."""

from __future__ import annotations

from . import conversation_trie, decontaminate, fingerprint, mixing, oracle, packing, pipeline, quality, recompression, secrets, simhash, surrogates, token_counts, url_filter, whitening

QUERIES = {
    "op1_surrogates": surrogates.op1_surrogates,
    "op2_simhash": simhash.op2_simhash,
    "op3_decontamination": decontaminate.op3_decontamination,
    "op4_secrets": secrets.op4_secrets,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_packing": packing.op6_packing,
    "op7_fingerprint": fingerprint.op7_fingerprint,
    "op8_url_filter": url_filter.op8_url_filter,
    "op9_repeats": recompression.op9_repeats,
    "op10_quality": quality.op10_quality,
    "op11_whitening": whitening.op11_whitening,
    "op12_mixing": mixing.op12_mixing,
    "op13_conversation_trie": conversation_trie.op13_conversation_trie,
    "pipeline": pipeline.run,
}

ORACLE = {"op3_decontamination": oracle.OP3, "op9_repeats": oracle.OP9, "op13_conversation_trie": oracle.OP13}
