"""The subpackage's registered queries and, where SQL can express them, their SQL."""

from __future__ import annotations

from pvscan.llm import chat, decontaminate, jaccard, kneser_ney, mixing, sstable, substrings, toxicity, url_filter, winnow

QUERIES = {
    "op1_quality": kneser_ney.op1_quality,
    "op2_url_filter": url_filter.op2_url_filter,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_chat": chat.op4_chat,
    "op5_winnowing": winnow.op5_winnowing,
    "op6_mixing": mixing.op6_mixing,
    "op7_decontamination": decontaminate.op7_decontamination,
    "op8_jaccard": jaccard.op8_jaccard,
    "op9_sstable": sstable.op9_sstable,
    "op10_substrings": substrings.op10_substrings,
}

ORACLE_SQL = {
    "op2_url_filter": url_filter.SQL,
    "op4_chat": chat.SQL,
    "op7_decontamination": decontaminate.SQL,
    "op8_jaccard": jaccard.SQL,
    "op10_substrings": substrings.SQL,
}
