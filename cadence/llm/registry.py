"""The queries of this package, and the SQL for those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from cadence.llm import chat, collocations, lsh, negatives, sharding, topk
from cadence.llm.bpe import op10_bpe
from cadence.llm.chat import op9_chat
from cadence.llm.collocations import op12_collocations
from cadence.llm.lsh import op7_lsh
from cadence.llm.minhash import op1_minhash
from cadence.llm.mixing import op11_mixing
from cadence.llm.negatives import op13_negatives
from cadence.llm.packing import op2_packing
from cadence.llm.quality import op8_quality
from cadence.llm.sharding import op6_sharding
from cadence.llm.suffix import op3_suffix
from cadence.llm.topk import op5_topk
from cadence.llm.toxicity import op4_toxicity

QUERIES = {
    "op1_minhash": op1_minhash, "op2_packing": op2_packing, "op3_suffix": op3_suffix, "op4_toxicity": op4_toxicity,
    "op5_topk": op5_topk, "op6_sharding": op6_sharding, "op7_lsh": op7_lsh, "op8_quality": op8_quality,
    "op9_chat": op9_chat, "op10_bpe": op10_bpe, "op11_mixing": op11_mixing, "op12_collocations": op12_collocations, "op13_negatives": op13_negatives, "pipeline": corpus_pipeline.run}

ORACLES = {"op5_topk": topk.ORACLE, "op6_sharding": sharding.ORACLE, "op7_lsh": lsh.ORACLE, "op9_chat": chat.ORACLE, "op12_collocations": collocations.ORACLE, "op13_negatives": negatives.ORACLE}
