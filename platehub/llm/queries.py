"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from .chat import OP4_SQL, op4_chat
from .decontaminate import op7_decontaminate
from .host_rules import OP6_SQL, op6_host_rules
from .jaccard import OP5_SQL, op5_jaccard
from .language import op12_language
from .licenses import OP2_SQL, op2_licenses
from .line_dedup import op8_line_dedup
from .link_graph import op9_link_graph
from .mixing import OP3_SQL, op3_mixing
from .phrases import OP13_SQL, op13_phrases
from .quality import op1_quality
from .runs import op11_runs
from .suffixes import op10_suffixes

QUERIES = {
    "op1_quality": op1_quality,
    "op2_licenses": op2_licenses,
    "op3_mixing": op3_mixing,
    "op4_chat": op4_chat,
    "op5_jaccard": op5_jaccard,
    "op6_host_rules": op6_host_rules,
    "op7_decontaminate": op7_decontaminate,
    "op8_line_dedup": op8_line_dedup,
    "op9_link_graph": op9_link_graph,
    "op10_suffixes": op10_suffixes,
    "op11_runs": op11_runs,
    "op12_language": op12_language,
    "op13_phrases": op13_phrases,
}
ORACLE = {
    "op2_licenses": OP2_SQL,
    "op3_mixing": OP3_SQL,
    "op4_chat": OP4_SQL,
    "op5_jaccard": OP5_SQL,
    "op6_host_rules": OP6_SQL,
    "op13_phrases": OP13_SQL,
}
