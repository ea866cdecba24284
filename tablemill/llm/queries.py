"""Queries of the training-data operators and their SQL, where SQL can express them."""

from __future__ import annotations

from tablemill.llm import chat, decontam, knn, licenses, linededup, neardup, packing, pii, quality, warc

QUERIES = {
    "op1_pii": pii.op1,
    "op2_line_dedup": linededup.op2,
    "op3_quality": quality.op3,
    "op4_decontamination": decontam.op4,
    "op5_topk": knn.op5,
    "op6_packing": packing.op6,
    "op7_warc": warc.op7,
    "op8_chat": chat.op8,
    "op9_licenses": licenses.op9,
    "op10_near_dedup": neardup.op10,
}
SQL = {"op2_line_dedup": linededup.SQL, "op4_decontamination": decontam.SQL, "op5_topk": knn.SQL, "op7_warc": warc.SQL, "op8_chat": chat.SQL, "op10_near_dedup": neardup.SQL}
