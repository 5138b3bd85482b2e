"""The registered queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from timberline.llm.decontamination import op4_decontamination
from timberline.llm.mixing import op13_mixing
from timberline.llm.neardup import op2_neardup
from timberline.llm.negatives import op12_negatives
from timberline.llm.oracles import ORACLES
from timberline.llm.packing import op3_packing
from timberline.llm.pii import op7_pii
from timberline.llm.sharding import op1_sharding
from timberline.llm.substrings import op5_substrings
from timberline.llm.topk import op6_topk
from timberline.llm.toxicity import op8_toxicity
from timberline.llm.urls import op9_urls
from timberline.llm.warc import op10_warc
from timberline.llm.whitening import op11_whitening

QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_neardup": op2_neardup,
    "op3_packing": op3_packing,
    "op4_decontamination": op4_decontamination,
    "op5_substrings": op5_substrings,
    "op6_topk": op6_topk,
    "op7_pii": op7_pii,
    "op8_toxicity": op8_toxicity,
    "op9_urls": op9_urls,
    "op10_warc": op10_warc,
    "op11_whitening": op11_whitening,
    "op12_negatives": op12_negatives,
    "op13_mixing": op13_mixing,
}

__all__ = ["ORACLES", "QUERIES"]
