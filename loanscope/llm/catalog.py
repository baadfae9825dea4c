"""Queries of this subpackage and the DuckDB text of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loanscope.llm.chat import OP9_SQL, op9_chat_formatting
from loanscope.llm.content import op12_html_extraction
from loanscope.llm.decontam import op6_decontamination
from loanscope.llm.exact_dedup import OP5_SQL, op5_exact_dedup
from loanscope.llm.langid import op7_language_id
from loanscope.llm.lexical import OP11_SQL, op11_lexical_search
from loanscope.llm.license_scan import op1_license_scan, op1_sql
from loanscope.llm.mixing import op2_source_mixing
from loanscope.llm.pii import op4_pii
from loanscope.llm.repair import op13_conversation_repair, op13_sql
from loanscope.llm.simhash import op10_simhash_dedup
from loanscope.llm.token_counts import op8_token_counts
from loanscope.llm.toxicity import op3_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_source_mixing": op2_source_mixing,
    "op3_toxicity": op3_toxicity,
    "op4_pii": op4_pii,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_decontamination": op6_decontamination,
    "op7_language_id": op7_language_id,
    "op8_token_counts": op8_token_counts,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_simhash_dedup": op10_simhash_dedup,
    "op11_lexical_search": op11_lexical_search,
    "op12_html_extraction": op12_html_extraction,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLES: dict[str, str] = {"op1_license_scan": op1_sql(), "op5_exact_dedup": OP5_SQL, "op9_chat_formatting": OP9_SQL,
                           "op11_lexical_search": OP11_SQL, "op13_conversation_repair": op13_sql()}
