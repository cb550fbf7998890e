"""Queries of the training-data operators, one for each, over whole tables."""

from __future__ import annotations

from . import blobs, chat, decontam, langid, lines, media, neardup, packing, tokens, toxicity

QUERIES = {
    f.__name__: f
    for f in (
        media.op1_matroska,
        packing.op2_best_fit,
        neardup.op3_tensored_minhash,
        blobs.op4_blob_ledger,
        langid.op5_string_kernel,
        decontam.op6_inverted_index,
        lines.op7_deletion_neighbourhood,
        toxicity.op8_conv_toxicity,
        tokens.op9_token_counts,
        chat.op10_event_sourced,
    )
}

ORACLE_SQL = {
    "op3_tensored_minhash": neardup.OP3_SQL,
    "op6_inverted_index": decontam.OP6_SQL,
    "op7_deletion_neighbourhood": lines.OP7_SQL,
    "op10_event_sourced": chat.OP10_SQL,
}
