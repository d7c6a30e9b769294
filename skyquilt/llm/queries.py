"""The queries of this folder and, where SQL can express them, their DuckDB equivalents."""

from __future__ import annotations

from skyquilt.llm import chat_format, decontaminate, language_model, licenses, near_dup, phrases, quality, quality_fm, sentence_piece, sharding, token_files, vector_codes, warc

QUERIES = {
    "op1_sharding": sharding.op1_sharding,
    "op2_warc": warc.op2_warc,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_sentence_piece": sentence_piece.op4_sentence_piece,
    "op5_token_files": token_files.op5_token_files,
    "op6_quality": quality.op6_quality,
    "op7_licenses": licenses.op7_licenses,
    "op8_language_model": language_model.op8_language_model,
    "op9_chat_format": chat_format.op9_chat_format,
    "op10_near_duplicates": near_dup.op10_near_duplicates,
    "op11_phrases": phrases.op11_phrases,
    "op12_quality_machine": quality_fm.op12_quality_machine,
    "op13_vector_codes": vector_codes.op13_vector_codes,
}
ORACLE_SQL = {
    "op3_decontaminate": decontaminate.OP3_SQL,
    "op6_quality": quality.OP6_SQL,
    "op7_licenses": licenses.OP7_SQL,
    "op9_chat_format": chat_format.OP9_SQL,
    "op11_phrases": phrases.OP11_SQL,
    "op13_vector_codes": vector_codes.OP13_SQL,
}
