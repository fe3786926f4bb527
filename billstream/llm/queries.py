"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from billstream.llm import (
    byte_bpe,
    chat,
    collocations,
    decontaminate,
    embedding_pairs,
    language_crf,
    line_dedup,
    pii,
    simhash,
    suffix_dedup,
    token_store,
    vector_codes,
    word_dedup,
)

QUERIES = {
    "op1_token_store": token_store.op1_token_store,
    "op2_pii": pii.op2_pii,
    "op3_byte_bpe": byte_bpe.op3_byte_bpe,
    "op4_chat_formatting": chat.op4_chat_formatting,
    "op5_word_dedup": word_dedup.op5_word_dedup,
    "op6_embedding_pairs": embedding_pairs.op6_embedding_pairs,
    "op7_language_crf": language_crf.op7_language_crf,
    "op8_simhash": simhash.op8_simhash,
    "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
    "op10_decontamination": decontaminate.op10_decontamination,
    "op11_line_dedup": line_dedup.op11_line_dedup,
    "op12_collocations": collocations.op12_collocations,
    "op13_vector_codes": vector_codes.op13_vector_codes,
}

SQL = {
    "op4_chat_formatting": chat.OP4_SQL,
    "op10_decontamination": decontaminate.OP10_SQL,
    "op11_line_dedup": line_dedup.op11_line_dedup,
    "op11_line_dedup": line_dedup.OP11_SQL,
    "op12_collocations": collocations.OP12_SQL,
    "op13_vector_codes": vector_codes.OP13_SQL,
}
