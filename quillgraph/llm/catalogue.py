"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from .bpe import op3_bpe
from .chat import OP7_SQL, op7_chat
from .html_text import op1_html_text
from .lm import op10_lm
from .mixing import OP2_SQL, op2_mixing
from .near_dup import OP8_SQL, op8_near_dup
from .neighbours import op6_neighbours
from .quality_rules import OP5_SQL, op5_quality_rules
from .toxicity import op4_toxicity
from .urls import op9_url_filters

QUERIES = {
    "op1_html_text": op1_html_text,
    "op2_mixing": op2_mixing,
    "op3_bpe": op3_bpe,
    "op4_toxicity": op4_toxicity,
    "op5_quality_rules": op5_quality_rules,
    "op6_neighbours": op6_neighbours,
    "op7_chat": op7_chat,
    "op8_near_dup": op8_near_dup,
    "op9_url_filters": op9_url_filters,
    "op10_lm": op10_lm,
}
ORACLES: dict = {
    "op2_mixing": OP2_SQL,
    "op5_quality_rules": OP5_SQL,
    "op7_chat": OP7_SQL,
    "op8_near_dup": OP8_SQL,
}
