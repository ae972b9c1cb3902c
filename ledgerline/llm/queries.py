"""The registered queries of this subpackage and their SQL."""

from ledgerline.llm import collocations, decontaminate, divergence, mixing, passages, private_data, quality, simhash, token_counts, token_files, tool_calls, toxicity, vectors

QUERIES = {
    "op2_quality": quality.op2_quality,
    "op7_mix": mixing.op7_mix,
    "op1_token_counts": token_counts.op1_token_counts,
    "op10_token_ids": token_files.op10_token_ids,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op3_toxicity": toxicity.op3_toxicity,
    "op5_vectors": vectors.op5_vectors,
    "op8_tool_calls": tool_calls.op8_tool_calls,
    "op6_private": private_data.op6_private,
    "op4_simhash": simhash.op4_simhash,
    "op11_passages": passages.op11_passages,
    "op12_divergence": divergence.op12_divergence,
    "op13_collocations": collocations.op13_collocations,
}
ORACLE_SQL: dict[str, str] = {"op8_tool_calls": tool_calls.OP8_SQL, "op12_divergence": divergence.OP12_SQL}
