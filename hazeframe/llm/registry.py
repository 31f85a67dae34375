"""The operators of this package as named queries over the test tables, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hazeframe.llm import (
    byte_bpe,
    chunk_recipes,
    dual_tree,
    itq,
    licenses,
    minhash,
    one_bit,
    ordinal,
    packing,
    secrets,
    spelling,
    toxicity,
    url_rules,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": licenses.op1,
    "op2_packing": packing.op2,
    "op3_minhash_near_duplicates": minhash.op3,
    "op4_secret_scan": secrets.op4,
    "op5_quality_classifier": ordinal.op5,
    "op6_exact_duplicates": chunk_recipes.op6,
    "op7_url_rules": url_rules.op7,
    "op8_byte_bpe": byte_bpe.op8,
    "op9_toxicity": toxicity.op9,
    "op10_embedding_near_duplicates": itq.op10,
    "op11_vector_codes": dual_tree.op11,
    "op12_nearest_vectors": one_bit.op12,
    "op13_spelling_variants": spelling.op13,
}

ORACLES: dict[str, str] = {
    "op1_license_scan": licenses.ORACLE,
    "op6_exact_duplicates": chunk_recipes.ORACLE,
    "op7_url_rules": url_rules.ORACLE,
    "op11_vector_codes": dual_tree.ORACLE,
    "op12_nearest_vectors": one_bit.ORACLE,
}
