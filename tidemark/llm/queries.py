"""The registered query of each operator and its oracle SQL, where SQL can say it."""

from __future__ import annotations

from tidemark.llm import alignment, bpe_trie, decontaminate, exact_dedup, html_text, langid, lexical, lm, mixing, simhash, token_counts, token_ids, warc

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_language_id": langid.op2_language_id,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_token_ids": token_ids.op4_token_ids,
    "op5_lm_scoring": lm.op5_lm_scoring,
    "op6_mixing": mixing.op6_mixing,
    "op7_html_text": html_text.op7_html_text,
    "op8_decontaminate": decontaminate.op8_decontaminate,
    "op9_token_counts": token_counts.op9_token_counts,
    "op10_warc": warc.op10_warc,
    "op11_bpe_trie": bpe_trie.op11_bpe_trie,
    "op12_alignment": alignment.op12_alignment,
    "op13_lexical_search": lexical.op13_lexical_search,
}

#: DuckDB SQL by query; the others are tested against brute force in tests/llm.
ORACLE: dict[str, str] = {
    "op3_exact_dedup": exact_dedup.SQL,
    "op8_decontaminate": decontaminate.SQL,
    "op10_warc": warc.SQL,
    "op13_lexical_search": lexical.SQL,
}
