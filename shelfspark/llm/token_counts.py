"""Exact histogram of encoded document lengths, and what its suffix sums answer."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm.common import written
from shelfspark.llm.hashing import tidy
from shelfspark.llm.wordids import encoder, slices

BLOCK = 1024


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def document_lengths(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id and n_tokens of every row (null text: 0 tokens)."""
    path = tokenizer or default_tokenizer()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(enc.counts(part["text"]), pa.int64())], ["doc_id", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(tidy(count), docs.select("doc_id").schema.add("n_tokens", "long"))


def length_histogram(lengths: DataFrame, column: str = "n_tokens") -> DataFrame:
    """n_tokens and n_docs: one row per length that occurs. Null lengths are left out."""
    return lengths.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("n_tokens")).agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For each length L that occurs: documents and tokens at L, and the sums over all longer documents.

    The sums run within blocks of ``BLOCK`` lengths, and the sums of later blocks are added, so no
    task sorts the whole histogram.
    """
    h = histogram.withColumn("_block", F.floor(F.col("n_tokens") / BLOCK)).withColumn("_t", F.col("n_tokens") * F.col("n_docs"))
    after = lambda by: Window.orderBy(by).rowsBetween(1, Window.unboundedFollowing)
    blocks = h.groupBy("_block").agg(F.sum("n_docs").alias("_bd"), F.sum("_t").alias("_bt"))
    later = blocks.select("_block", F.coalesce(F.sum("_bd").over(after("_block")), F.lit(0)).alias("_ld"),
                          F.coalesce(F.sum("_bt").over(after("_block")), F.lit(0)).alias("_lt"))
    w = Window.partitionBy("_block").orderBy("n_tokens").rowsBetween(1, Window.unboundedFollowing)
    return h.join(later, "_block").select(
        "n_tokens", "n_docs", F.col("_t").alias("tokens"),
        (F.coalesce(F.sum("n_docs").over(w), F.lit(0)) + F.col("_ld")).alias("longer_docs"),
        (F.coalesce(F.sum("_t").over(w), F.lit(0)) + F.col("_lt")).alias("longer_tokens"))


def context_table(lengths: DataFrame) -> DataFrame:
    """One row per context limit at which an answer changes, that is per length that occurs.

    context_limit, n_docs (of just that length), longer_docs, total_tokens, kept_tokens (sum of min(length,
    limit) over all documents), dropped_tokens, and quantile (share of documents no longer than the limit).
    Limits between two rows are exact by ``truncated_total``. An empty table gives an empty result.
    """
    sums = suffix_sums(written(length_histogram(lengths)))  # read by several branches: texts are encoded once
    total = sums.agg(F.struct(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t")).alias("a")).scalar()
    cut = F.col("longer_tokens") - F.col("longer_docs") * F.col("n_tokens")
    return sums.withColumn("_a", total).select(
        F.col("n_tokens").alias("context_limit"), "n_docs", "longer_docs", F.col("_a.t").alias("total_tokens"),
        (F.col("_a.t") - cut).alias("kept_tokens"), cut.alias("dropped_tokens"),
        (1 - F.col("longer_docs") / F.col("_a.d")).alias("quantile"))


def truncated_total(sums: DataFrame, limit: int) -> int:
    """Tokens kept when every document is cut at ``limit``, from the suffix sums: tokens of documents up to the limit, and limit each for the others."""
    row = sums.agg(F.sum(F.when(F.col("n_tokens") <= limit, F.col("tokens")).otherwise(F.col("n_docs") * limit)).alias("t")).first()
    return int(row["t"] or 0)


def length_quantile(sums: DataFrame, share: float) -> int | None:
    """Smallest length that at least ``share`` of the documents do not exceed; None without documents."""
    total = sums.agg(F.sum("n_docs").alias("d")).first()["d"]
    if not total:
        return None
    return sums.filter(F.col("longer_docs") <= total * (1 - share) + 1e-9).agg(F.min("n_tokens").alias("q")).first()["q"]


def token_counts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The context table of whole documents. Null text counts as 0 tokens; repeated rows count each; other columns are left out."""
    return context_table(document_lengths(docs, tokenizer))
