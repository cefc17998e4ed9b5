"""The queries of the corpus operators, by name, and their DuckDB twins."""

from __future__ import annotations

from arrayloom.llm import bpe, fingerprints, mixing, neardup, secrets, sharding, substrings, suffixes, toxicity, vectors

QUERIES = {
    f.__name__: f
    for f in (
        toxicity.op1_toxicity_pu,
        mixing.op2_source_mixing,
        bpe.op3_bpe_codec,
        sharding.op4_hilbert_sharding,
        substrings.op5_repeated_phrases,
        suffixes.op6_common_prefix_intervals,
        neardup.op7_minhash_multi_index,
        secrets.op8_secret_formats,
        fingerprints.op9_i_match,
        vectors.op10_vector_approximation_search,
    )
}
ORACLES = {
    "op2_source_mixing": mixing.ORACLE,
    "op5_repeated_phrases": substrings.ORACLE,
    "op6_common_prefix_intervals": suffixes.ORACLE,
    "op7_minhash_multi_index": neardup.ORACLE,
    "op10_vector_approximation_search": vectors.ORACLE,
}
