"""Queries of this subpackage, as __spark_entry__.py registers them."""

from __future__ import annotations

from . import exactdedup, htmlmain, linededup, mixing, pieces, quality, sharding, simhash, toxicity, warc

QUERIES = {
    "op1_sharding": sharding.op1_sharding,
    "op2_exact_dedup": exactdedup.op2_exact_dedup,
    "op3_sentencepiece": pieces.op3_sentencepiece,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_simhash": simhash.op5_simhash,
    "op6_quality_rules": quality.op6_quality_rules,
    "op7_html_extraction": htmlmain.op7_html_extraction,
    "op8_mixing": mixing.op8_mixing,
    "op9_line_dedup": linededup.op9_line_dedup,
    "op10_warc": warc.op10_warc,
}
ORACLE: dict[str, str] = {
    "op2_exact_dedup": exactdedup.OP2_SQL,
    "op6_quality_rules": quality.OP6_SQL,
    "op8_mixing": mixing.OP8_SQL,
    "op9_line_dedup": linededup.OP9_SQL,
    "op10_warc": warc.OP10_SQL,
}
