"""Registered queries of this package and the SQL they are compared with."""

from __future__ import annotations

from merchlens.llm.alignment import op12_alignment
from merchlens.llm.collocations import OP13_SQL, op13_collocations
from merchlens.llm.decontaminate import op3_decontaminate
from merchlens.llm.licenses import op7_licenses
from merchlens.llm.mixture import op2_mixture
from merchlens.llm.neighbours import op5_neighbours
from merchlens.llm.packing import op4_packing
from merchlens.llm.pieces import op11_pieces
from merchlens.llm.quality import op6_quality
from merchlens.llm.secrets import op8_secrets
from merchlens.llm.simhash import op10_simhash
from merchlens.llm.toxicity import op9_toxicity
from merchlens.llm.warc import OP1_SQL, op1_warc

QUERIES = {
    "op1_warc": op1_warc,
    "op2_mixture": op2_mixture,
    "op3_decontaminate": op3_decontaminate,
    "op4_packing": op4_packing,
    "op5_neighbours": op5_neighbours,
    "op6_quality": op6_quality,
    "op7_licenses": op7_licenses,
    "op8_secrets": op8_secrets,
    "op9_toxicity": op9_toxicity,
    "op10_simhash": op10_simhash,
    "op11_pieces": op11_pieces,
    "op12_alignment": op12_alignment,
    "op13_collocations": op13_collocations,
}
ORACLE = {"op1_warc": OP1_SQL, "op13_collocations": OP13_SQL}
