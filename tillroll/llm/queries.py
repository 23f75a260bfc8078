"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from tillroll.llm.conversations import OP12_SQL, op12_conversation_repair
from tillroll.llm.html import op10_html
from tillroll.llm.language import op8_language
from tillroll.llm.maxent import op13_lm_scoring
from tillroll.llm.middle import OP11_SQL, op11_fill_in_middle
from tillroll.llm.mixing import OP7_SQL, op7_mixing
from tillroll.llm.fingerprints import op4_fingerprints
from tillroll.llm.neardup import op2_near_duplicates
from tillroll.llm.packing import op3_packing
from tillroll.llm.quality import op5_quality
from tillroll.llm.secrets import op9_secrets
from tillroll.llm.sharding import op1_sharding
from tillroll.llm.toxicity import op6_toxicity

QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_packing": op3_packing,
    "op4_fingerprints": op4_fingerprints,
    "op5_quality": op5_quality,
    "op6_toxicity": op6_toxicity,
    "op7_mixing": op7_mixing,
    "op8_language": op8_language,
    "op9_secrets": op9_secrets,
    "op10_html": op10_html,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_lm_scoring": op13_lm_scoring,
}
ORACLE = {"op7_mixing": OP7_SQL, "op11_fill_in_middle": OP11_SQL, "op12_conversation_repair": OP12_SQL}
