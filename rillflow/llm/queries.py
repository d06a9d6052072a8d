"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import op04_exact, op08_lines, op11_topk, op12_filters, op13_merkle
from .op01_decontamination import op01_decontamination
from .op02_bpe import op02_bpe
from .op03_toxicity import op03_toxicity
from .op05_html import op05_html
from .op06_tokens import op06_tokens
from .op07_quality import op07_quality
from .op09_simhash import op09_simhash
from .op10_language import op10_language
from .util import table


def _over(f: Callable[..., DataFrame], *tables: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: f(*(table(spark, sf_dir, t) for t in tables))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": _over(op01_decontamination, "documents", "benchmark"),
    "op2_byte_bpe": _over(op02_bpe, "documents"),
    "op3_toxicity": _over(op03_toxicity, "documents", "labels"),
    "op4_exact_dedup": _over(op04_exact.op04_exact, "documents"),
    "op5_html_extraction": _over(op05_html, "pages"),
    "op6_token_counts": _over(op06_tokens, "documents"),
    "op7_quality": _over(op07_quality, "documents", "labels"),
    "op8_line_dedup": _over(op08_lines.op08_lines, "documents"),
    "op9_simhash": _over(op09_simhash, "documents"),
    "op10_language_id": _over(op10_language, "documents"),
    "op11_exact_topk": _over(op11_topk.op11_topk, "embeddings"),
    "op12_filter_audit": _over(op12_filters.op12_filters, "documents", "labels"),
    "op13_merkle_manifest": _over(op13_merkle.op13_merkle, "documents"),
}

ORACLES: dict[str, str] = {
    "op4_exact_dedup": op04_exact.ORACLE,
    "op8_line_dedup": op08_lines.ORACLE,
    "op11_exact_topk": op11_topk.ORACLE,
    "op12_filter_audit": op12_filters.ORACLE,
    "op13_merkle_manifest": op13_merkle.ORACLE,
}
