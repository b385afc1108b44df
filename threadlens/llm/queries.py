"""The registered queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from threadlens.llm.shared import read_table

#: query -> (module, tables it works on)
OPERATORS = {
    "op1_simhash_decontam": ("decontam", "documents", "benchmark"),
    "op2_token_fertility": ("fertility", "documents"),
    "op3_bilstm_pii": ("pii", "documents"),
    "op4_main_text": ("blocks", "pages"),
    "op5_source_mix": ("mixing", "documents"),
    "op6_license_dice": ("licenses", "documents"),
    "op7_credential_ownership": ("credentials", "documents"),
    "op8_ngram_jaccard": ("ngram_join", "documents"),
    "op9_centroid_language": ("centroids", "documents"),
    "op10_hilbert_shards": ("hilbert", "documents"),
    "op11_bpe_backtrack": ("bpe", "documents"),
    "op12_merkle_versions": ("merkle", "documents"),
    "op13_conversation_repair": ("repair", "conversations"),
}
#: query -> name of its DuckDB SQL in that module
SQL = {
    "op6_license_dice": "OP6_SQL",
    "op5_source_mix": "OP5_SQL",
}


def _query(name: str, module: str, *tables: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply = getattr(importlib.import_module(f"threadlens.llm.{module}"), name)
        return apply(*[read_table(spark, sf_dir, table) for table in tables])

    run.__name__ = name
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _query(name, *of) for name, of in OPERATORS.items()}


def oracle_sql() -> dict[str, str]:
    return {name: getattr(importlib.import_module(f"threadlens.llm.{OPERATORS[name][0]}"), sql) for name, sql in SQL.items()}
