"""The queries of the training-data operators and their SQL."""

from __future__ import annotations

from .chat import OP5_SQL, op5_query
from .common import table
from .decontaminate import OP4_SQL, op4_query
from .langid import op3_query
from .mixing import OP10_SQL, op10_query
from .pii import op1_query
from .quality import OP8_SQL, op8_query
from .secrets import op7_query
from .simhash import op9_query
from .substring import OP2_SQL, op2_query
from .suffix import op6_query

QUERIES = {
    "op1_pii": lambda spark, sf: op1_query(table(spark, sf, "documents")),
    "op2_substring_dedup": lambda spark, sf: op2_query(table(spark, sf, "documents")),
    "op3_language_id": lambda spark, sf: op3_query(table(spark, sf, "documents")),
    "op4_decontamination": lambda spark, sf: op4_query(table(spark, sf, "documents"), table(spark, sf, "benchmark")),
    "op5_chat_rotation": lambda spark, sf: op5_query(table(spark, sf, "conversations")),
    "op6_suffix_dedup": lambda spark, sf: op6_query(table(spark, sf, "documents")),
    "op7_secret_scan": lambda spark, sf: op7_query(table(spark, sf, "documents")),
    "op8_quality_rules": lambda spark, sf: op8_query(spark, table(spark, sf, "documents")),
    "op9_simhash": lambda spark, sf: op9_query(table(spark, sf, "documents")),
    "op10_mixing": lambda spark, sf: op10_query(spark, table(spark, sf, "documents")),
}

ORACLE = {
    "op2_substring_dedup": OP2_SQL,
    "op4_decontamination": OP4_SQL,
    "op5_chat_rotation": OP5_SQL,
    "op8_quality_rules": OP8_SQL,
    "op10_mixing": OP10_SQL,
}
