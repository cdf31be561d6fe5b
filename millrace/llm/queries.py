"""The registered queries of the corpus operators, and their SQL."""

from __future__ import annotations

from millrace.llm import chat, decontaminate, embedding, jaccard, langid, negatives, packing, quality, substring, toxicity, trie, urls, warc

QUERIES = {
    "op1_url_filter": urls.query,
    "op2_benchmark_decontamination": decontaminate.query,
    "op3_embedding_near_dedup": embedding.query,
    "op4_language_id": langid.query,
    "op5_quality": quality.query,
    "op6_toxicity": toxicity.query,
    "op7_substring_dedup": substring.query,
    "op8_ngram_jaccard_join": jaccard.query,
    "op9_best_fit_packing": packing.query,
    "op10_chat_formatting": chat.query,
    "op11_prefix_trie": trie.query,
    "op12_warc": warc.query,
    "op13_hard_negatives": negatives.query,
}

ORACLE_SQL = {
    "op1_url_filter": urls.ORACLE,
    "op3_embedding_near_dedup": embedding.ORACLE,
    "op10_chat_formatting": chat.ORACLE,
    "op11_prefix_trie": trie.ORACLE,
    "op12_warc": warc.ORACLE,
    "op13_hard_negatives": negatives.ORACLE,
}
