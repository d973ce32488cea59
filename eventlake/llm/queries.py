"""Registered queries of the operators and their DuckDB SQL."""

from __future__ import annotations

from eventlake.llm.chat import OP3_SQL, op3_chat
from eventlake.llm.counts import op12_counts
from eventlake.llm.decontaminate import OP2_SQL, op2_decontaminate
from eventlake.llm.extract import op9_extract
from eventlake.llm.mixing import op4_mixing
from eventlake.llm.quality import op6_quality
from eventlake.llm.repair import op13_repair
from eventlake.llm.secrets import op8_secrets
from eventlake.llm.simhash import op5_simhash
from eventlake.llm.tokens import op7_tokens
from eventlake.llm.urls import OP1_SQL, op1_urls
from eventlake.llm.variants import op11_variants
from eventlake.llm.warc import OP10_SQL, op10_warc

QUERIES = {
    "op9_extract": op9_extract,
    "op10_warc": op10_warc,
    "op8_secrets": op8_secrets,
    "op3_chat": op3_chat,
    "op1_urls": op1_urls,
    "op4_mixing": op4_mixing,
    "op2_decontaminate": op2_decontaminate,
    "op7_tokens": op7_tokens,
    "op5_simhash": op5_simhash,
    "op6_quality": op6_quality,
    "op12_counts": op12_counts,
    "op13_repair": op13_repair,
    "op11_variants": op11_variants,
}

ORACLE_SQL: dict[str, str] = {
    "op10_warc": OP10_SQL,
    "op3_chat": OP3_SQL,
    "op1_urls": OP1_SQL,
    "op2_decontaminate": OP2_SQL,
}
