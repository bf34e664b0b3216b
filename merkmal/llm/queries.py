"""Queries of this package and their SQL, where SQL can express them."""

from __future__ import annotations

from merkmal.llm.codes import OP12_SQL, op12_codes
from merkmal.llm.decontaminate import op3_decontaminate
from merkmal.llm.divergence import OP11_SQL, op11_divergence
from merkmal.llm.html_text import op9_html_text
from merkmal.llm.licenses import op5_licenses
from merkmal.llm.near_vectors import op10_near_vectors
from merkmal.llm.packing import op1_packing
from merkmal.llm.private import op13_private
from merkmal.llm.sharding import op8_sharding
from merkmal.llm.shingle_join import op7_shingle_join
from merkmal.llm.substrings import op4_substrings
from merkmal.llm.toxicity import op2_toxicity
from merkmal.llm.warc import OP6_SQL, op6_warc

QUERIES = {
    "op1_packing": op1_packing,
    "op2_toxicity": op2_toxicity,
    "op3_decontaminate": op3_decontaminate,
    "op4_substrings": op4_substrings,
    "op5_licenses": op5_licenses,
    "op6_warc": op6_warc,
    "op7_shingle_join": op7_shingle_join,
    "op8_sharding": op8_sharding,
    "op9_html_text": op9_html_text,
    "op10_near_vectors": op10_near_vectors,
    "op11_divergence": op11_divergence,
    "op12_codes": op12_codes,
    "op13_private": op13_private,
}

ORACLES: dict[str, str] = {
    "op6_warc": OP6_SQL,
    "op11_divergence": OP11_SQL,
    "op12_codes": OP12_SQL,
}
