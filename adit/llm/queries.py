"""The queries of this folder, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adit.llm.bpe import op1_byte_bpe
from adit.llm.chat import OP6_SQL, op6_chat
from adit.llm.decision_list import op5_quality_rules
from adit.llm.exact_dedup import OP8_SQL, op8_exact_dedup
from adit.llm.fill_middle import OP13_SQL, op13_fill_in_middle
from adit.llm.language import op10_language_id
from adit.llm.mixing import OP4_SQL, op4_mixing
from adit.llm.pii import op3_pii
from adit.llm.preference import op9_quality_classifier
from adit.llm.resampling import OP11_SQL, op11_importance_resampling
from adit.llm.secrets import op12_secrets
from adit.llm.simhash import op2_simhash
from adit.llm.toxicity import op7_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_simhash": op2_simhash,
    "op3_pii": op3_pii,
    "op4_mixing": op4_mixing,
    "op5_quality_rules": op5_quality_rules,
    "op6_chat": op6_chat,
    "op7_toxicity": op7_toxicity,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_language_id": op10_language_id,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_secrets": op12_secrets,
    "op13_fill_in_middle": op13_fill_in_middle,
}
SQL: dict[str, str] = {
    "op4_mixing": OP4_SQL,
    "op6_chat": OP6_SQL,
    "op8_exact_dedup": OP8_SQL,
    "op11_importance_resampling": OP11_SQL,
    "op13_fill_in_middle": OP13_SQL,
}
