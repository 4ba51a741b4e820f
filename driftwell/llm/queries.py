"""Registry of the training-data queries and their SQL."""

from __future__ import annotations

from . import bpe, chat, exact, fim, forest, language, lines, merkle, minhash, packing, secrets, suffixes, winnow

QUERIES = {
    "op1_language": language.op1_language,
    "op2_suffix_merge": suffixes.op2_suffix_merge,
    "op3_packing": packing.op3_packing,
    "op4_secrets": secrets.op4_secrets,
    "op5_line_chunks": lines.op5_line_chunks,
    "op6_forest": forest.op6_forest,
    "op7_content_sort": exact.op7_content_sort,
    "op8_superminhash": minhash.op8_superminhash,
    "op9_chat": chat.op9_chat,
    "op10_bpe_automaton": bpe.op10_bpe,
    "op11_winnow": winnow.op11_winnow,
    "op12_fim": fim.op12_fim,
    "op13_merkle": merkle.op13_merkle,
}
ORACLE_SQL = {"op5_line_chunks": lines.OP5_SQL, "op7_content_sort": exact.OP7_SQL, "op11_winnow": winnow.OP11_SQL, "op12_fim": fim.OP12_SQL, "op13_merkle": merkle.OP13_SQL}
