"""The registered queries of the text operators, over whole tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfspark.llm import centroids, fingerprints, jaccard, licenses, lines, merkle, packing, personal, piece_codec, quality, repeats, sharding, token_counts
from shelfspark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _on_documents(name: str, operator: Callable[[DataFrame], DataFrame], sql: str | None = None) -> None:
    QUERIES[name] = lambda spark, sf_dir: operator(table(spark, sf_dir, "documents"))
    if sql:
        SQL[name] = sql


_on_documents("op1_license_scans", licenses.license_scan, licenses.license_sql())
_on_documents("op2_document_fingerprints", fingerprints.edited_fingerprints)
_on_documents("op3_best_fit_packing", packing.pack_documents)
_on_documents("op4_line_dedup", lines.line_report)
_on_documents("op5_sharding", sharding.shard_documents, sharding.SHARD_SQL.strip())
_on_documents("op6_quality_rules", quality.quality_documents, quality.quality_sql())
_on_documents("op7_suffix_array_dedup", repeats.repeat_report)
_on_documents("op8_token_counts", token_counts.token_counts)
_on_documents("op9_ngram_jaccard_join", jaccard.jaccard_classes)
_on_documents("op10_sentencepiece", piece_codec.encoding_report)
_on_documents("op11_merkle_manifest", merkle.manifest_report, merkle.manifest_sql())
_on_documents("op12_personal_data", personal.personal_report, personal.personal_sql())
QUERIES["op13_centroid_clusters"] = lambda spark, sf_dir: centroids.cluster_report(table(spark, sf_dir, "embeddings"))
SQL["op13_centroid_clusters"] = centroids.cluster_sql()
