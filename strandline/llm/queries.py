"""The registered queries: opN_<name>, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package
from ._common import load
from .chat import op8
from .fingerprints import op10
from .lines import op5
from .mixing import op2
from .near import op3
from .neighbours import op6
from .oracles import oracle_sql as oracle_sql
from .packing import op9
from .substrings import op4
from .suffixes import op1
from .toxicity import op7


def _on(table: str, op: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return op(load(spark, sf_dir, table))

    return query


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return op7(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_array": _on("documents", op1),
        "op2_source_mix": _on("documents", op2),
        "op3_near_duplicates": _on("documents", op3),
        "op4_substrings": _on("documents", op4),
        "op5_lines": _on("documents", op5),
        "op6_nearest_neighbours": _on("embeddings", op6),
        "op7_toxicity": _toxicity,
        "op8_chat_format": _on("conversations", op8),
        "op9_packing": _on("documents", op9),
        "op10_fingerprints": _on("documents", op10),
    }
