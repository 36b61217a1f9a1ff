"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from vellum.llm import bases
from vellum.llm.chat import OP7_SQL, op7_chat
from vellum.llm.decontaminate import OP8_SQL, op8_decontamination
from vellum.llm.licenses import op3_licenses
from vellum.llm.neighbours import op2_neighbours
from vellum.llm.packing import op6_packing
from vellum.llm.pii import op9_pii
from vellum.llm.quality import op10_quality
from vellum.llm.secrets import op5_secrets
from vellum.llm.simhash import op4_simhash
from vellum.llm.urls import op1_urls

QUERIES = {
    "op1_urls": op1_urls,
    "op2_neighbours": op2_neighbours,
    "op3_licenses": op3_licenses,
    "op4_simhash": op4_simhash,
    "op5_secrets": op5_secrets,
    "op6_packing": op6_packing,
    "op7_chat": op7_chat,
    "op8_decontamination": op8_decontamination,
    "op9_pii": op9_pii,
    "op10_quality": op10_quality,
    **bases.QUERIES,
}
ORACLES: dict[str, str] = {
    "op7_chat": OP7_SQL,
    "op8_decontamination": OP8_SQL,
    **bases.ORACLES,
}
