"""Named queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    decontaminate,
    exact_dedup,
    jaccard_join,
    lm_score,
    mixing,
    pii,
    sharding,
    suffix_dedup,
    token_counts,
    toxicity,
    turn_repair,
    url_filter,
    vector_codes,
)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_suffix_dedup": suffix_dedup.deduplicated_documents,
    "op2_suffix_tree_score": lm_score.scored_documents,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_poisson_mixing": mixing.mixed_documents,
    "op5_jaccard_join": jaccard_join.linked_documents,
    "op6_url_filter": url_filter.judged_pages,
    "op7_toxicity": toxicity.scored_documents,
    "op8_decontamination": decontaminate.contaminated_documents,
    "op9_personal_data": pii.personal_data_of_documents,
    "op10_token_counts": token_counts.counted_documents,
    "op11_vector_codes": vector_codes.compressed_vectors,
    "op12_sharding": sharding.sharded_documents,
    "op13_turn_repair": turn_repair.repaired_conversations,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {
        "op3_exact_dedup": exact_dedup.ORACLE_SQL,
        "op4_poisson_mixing": mixing.oracle_sql(),
        "op11_vector_codes": vector_codes.oracle_sql(),
        "op13_turn_repair": turn_repair.ORACLE_SQL,
    }
