"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from saltmarsh.llm import (
    op1_warc,
    op2_token_counts,
    op3_ngram_jaccard,
    op4_tiff,
    op5_line_dedup,
    op6_url_rules,
    op7_quality_classifier,
    op8_sentencepiece,
    op9_packing,
    op10_quality_ledger,
    op11_filter_audit,
    op12_alignment,
    op13_edit_fingerprint,
)
from saltmarsh.llm.common import table, work

Query = Callable[[SparkSession, str], DataFrame]


def _in_folder(name: str, query: Query) -> Query:
    """The query, with its intermediate tables in a folder of its name (`common.clear` removes them)."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with work(name):
            return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: _in_folder(name, query) for name, query in _QUERIES.items()}


_QUERIES: dict[str, Query] = {
    "op1_warc": op1_warc.query,
    "op2_token_counts": op2_token_counts.query,
    "op3_ngram_jaccard": op3_ngram_jaccard.query,
    "op4_tiff": op4_tiff.query,
    "op5_line_dedup": op5_line_dedup.query,
    "op6_url_rules": op6_url_rules.query,
    "op7_quality_classifier": op7_quality_classifier.query,
    "op8_sentencepiece": op8_sentencepiece.query,
    "op9_packing": op9_packing.query,
    "op10_quality_ledger": lambda spark, d: op10_quality_ledger.digest(table(spark, d, "documents")),
    "op11_filter_audit": op11_filter_audit.query,
    "op12_alignment": op12_alignment.query,
    "op13_edit_fingerprint": op13_edit_fingerprint.query,
}


def oracle_sql() -> dict[str, str]:
    return {"op6_url_rules": op6_url_rules.ORACLE, "op10_quality_ledger": op10_quality_ledger.ORACLE, "op11_filter_audit": op11_filter_audit.ORACLE}
