"""The queries of this folder and, where SQL can express one, its DuckDB statement."""
from __future__ import annotations

from . import decontamination, jaccard, licenses, mixing, passages, pii, quality, syncmers, token_counts, warc

QUERIES = {
    "op1_syncmers": syncmers.op1_syncmers,
    "op2_decontamination": decontamination.op2_decontamination,
    "op3_passages": passages.op3_passages,
    "op4_mixing": mixing.op4_mixing,
    "op5_warc": warc.op5_warc,
    "op6_quality": quality.op6_quality,
    "op7_token_counts": token_counts.op7_token_counts,
    "op8_jaccard": jaccard.op8_jaccard,
    "op9_pii": pii.op9_pii,
    "op10_licenses": licenses.op10_licenses,
}
ORACLES: dict[str, str] = {
    "op2_decontamination": decontamination.OP2_SQL,
    "op3_passages": passages.OP3_SQL,
    "op4_mixing": mixing.OP4_SQL,
    "op5_warc": warc.OP5_SQL,
    "op8_jaccard": jaccard.OP8_SQL,
}
