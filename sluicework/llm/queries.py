"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from sluicework.llm import centroid_clustering, chat_tools, decontamination, embedding_whitening, host_rules, html_extraction, jaccard_join, line_dedup, mixing, quality_classifier, simhash, suffix_dedup, token_output

QUERIES = {
    "op1_quality": quality_classifier.op1_quality,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
    "op4_tool_linking": chat_tools.op4_tool_linking,
    "op5_decontamination": decontamination.op5_decontamination,
    "op6_token_output": token_output.op6_token_output,
    "op7_html_extraction": html_extraction.op7_html_extraction,
    "op8_host_rules": host_rules.op8_host_rules,
    "op9_jaccard_join": jaccard_join.op9_jaccard_join,
    "op10_mixing": mixing.op10_mixing,
    "op11_centroid_clustering": centroid_clustering.op11_centroid_clustering,
    "op12_simhash": simhash.op12_simhash,
    "op13_embedding_whitening": embedding_whitening.op13_embedding_whitening,
}

SQL = {
    "op3_suffix_dedup": suffix_dedup.OP3_SQL,
    "op4_tool_linking": chat_tools.OP4_SQL,
    "op8_host_rules": host_rules.OP8_SQL,
    "op9_jaccard_join": jaccard_join.OP9_SQL,
    "op11_centroid_clustering": centroid_clustering.OP11_SQL,
}
