"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from quire.llm import (chat_format, conversation_repair, fill_in_middle, kneser_ney, mixing, neighbours, packing, pii, repeats, rules, simhash, token_counts, warc)

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_packing": packing.op2_packing,
    "op3_repeats": repeats.op3_repeats,
    "op4_token_counts": token_counts.op4_token_counts,
    "op5_personal_data": pii.op5_personal_data,
    "op6_neighbours": neighbours.op6_neighbours,
    "op7_quality": kneser_ney.op7_quality,
    "op8_quality_rules": rules.op8_quality_rules,
    "op9_warc": warc.op9_warc,
    "op10_mixing": mixing.op10_mixing,
    "op11_conversation_repair": conversation_repair.op11_conversation_repair,
    "op12_fill_in_middle": fill_in_middle.op12_fill_in_middle,
    "op13_chat_format": chat_format.op13_chat_format,
}

ORACLE_SQL = {
    "op9_warc": warc.SQL,
    "op10_mixing": mixing.sql(),
    "op12_fill_in_middle": fill_in_middle.SQL,
    "op13_chat_format": chat_format.SQL,
}
