"""The registered queries of this package and their SQL twins, where SQL can express them."""

from __future__ import annotations

from quillwork.llm import chat_masks, decontamination, hamming_search, language, licenses, mixing, personal_data, prefix_trie, quality, resampling, simhash, toxicity, warc_zip

QUERIES = {
    "op1_language": language.op1_language,
    "op2_quality": quality.op2_quality,
    "op3_source_mix": mixing.op3_source_mix,
    "op4_license_scan": licenses.op4_license_scan,
    "op5_hamming_search": hamming_search.op5_hamming_search,
    "op6_decontamination": decontamination.op6_decontamination,
    "op7_personal_data": personal_data.op7_personal_data,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_simhash": simhash.op9_simhash,
    "op10_chat_masks": chat_masks.op10_chat_masks,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_resampling": resampling.op12_resampling,
    "op13_warc_zip": warc_zip.op13_warc_zip,
}
ORACLE_SQL = {
    "op3_source_mix": mixing.ORACLE_SQL,
    "op5_hamming_search": hamming_search.ORACLE_SQL,
    "op11_prefix_trie": prefix_trie.ORACLE_SQL,
    "op12_resampling": resampling.ORACLE_SQL,
    "op13_warc_zip": warc_zip.ORACLE_SQL,
}
