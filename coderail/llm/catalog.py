"""Queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from coderail.llm.op01_dac import op1_token_dac
from coderail.llm.op02_suffixes import OP2_SQL, op2_substring_suffixes
from coderail.llm.op03_token_counts import op3_token_counts
from coderail.llm.op04_quality import op4_quality_rules
from coderail.llm.op05_simhash import op5_simhash
from coderail.llm.op06_chaining import op6_fuzzy_passages
from coderail.llm.op07_licenses import op7_license_scan
from coderail.llm.op08_topk import OP8_SQL, op8_block_topk
from coderail.llm.op09_packing import op9_ffd_packing
from coderail.llm.op10_mixing import op10_mixing
from coderail.llm.op11_kmeans_tree import OP11_SQL, op11_kmeans_tree
from coderail.llm.op12_conversations import OP12_SQL, op12_conversation_repair
from coderail.llm.op13_lexical import OP13_SQL, op13_lexical_search

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_dac": op1_token_dac,
    "op2_substring_suffixes": op2_substring_suffixes,
    "op3_token_counts": op3_token_counts,
    "op4_quality_rules": op4_quality_rules,
    "op5_simhash": op5_simhash,
    "op6_fuzzy_passages": op6_fuzzy_passages,
    "op7_license_scan": op7_license_scan,
    "op8_block_topk": op8_block_topk,
    "op9_ffd_packing": op9_ffd_packing,
    "op10_mixing": op10_mixing,
    "op11_kmeans_tree": op11_kmeans_tree,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE_SQL: dict[str, str] = {"op2_substring_suffixes": OP2_SQL, "op8_block_topk": OP8_SQL, "op11_kmeans_tree": OP11_SQL,
                              "op12_conversation_repair": OP12_SQL, "op13_lexical_search": OP13_SQL}
