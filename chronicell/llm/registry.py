"""The subpackage's named queries and, where SQL can say the same, their SQL."""

from __future__ import annotations

from chronicell.llm.byte_bpe import op2_byte_bpe
from chronicell.llm.decontaminate import OP8_SQL, op8_decontaminate
from chronicell.llm.line_dedup import OP7_SQL, op7_line_dedup
from chronicell.llm.near_dedup import op4_near_dedup
from chronicell.llm.quality_classifier import op1_quality_classifier
from chronicell.llm.quality_rules import OP5_SQL, op5_quality_rules
from chronicell.llm.sharding import OP6_SQL, op6_sharding
from chronicell.llm.suffix_dedup import op10_suffix_dedup
from chronicell.llm.surrogates import op9_surrogates
from chronicell.llm.url_filter import op3_url_filter

QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_url_filter": op3_url_filter,
    "op4_near_dedup": op4_near_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_sharding": op6_sharding,
    "op7_line_dedup": op7_line_dedup,
    "op8_decontaminate": op8_decontaminate,
    "op9_surrogates": op9_surrogates,
    "op10_suffix_dedup": op10_suffix_dedup,
}
ORACLE_SQL = {
    "op5_quality_rules": OP5_SQL,
    "op6_sharding": OP6_SQL,
    "op7_line_dedup": OP7_SQL,
    "op8_decontaminate": OP8_SQL,
}
