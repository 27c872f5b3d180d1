"""Weighted shards by rendezvous hashing of stable record keys.

Every shard draws a number for every key from a hash of (key, shard); the
shard with the lowest ``-ln(u) / weight`` gets the record. The draw of a shard
depends on no other shard, so a new shard takes records only into itself and a
removed one gives up only its own.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm.common import kept_table

ROWS_PER_CELL = 20_000


def draw(key: Column, shard: int) -> Column:
    """Uniform number in (0, 1): 52 bits of md5('<key>:<shard>'); a null key hashes as the empty string."""
    text = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{shard}"))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def shard_of(key: Column, weights: Mapping[int, float]) -> Column:
    """Shard of a key under the given weights (shard number to positive weight); ties go to the lower number."""
    if not weights or any(w <= 0 for w in weights.values()):
        raise ValueError("every shard needs a positive weight")
    scores = [F.struct((-F.ln(draw(key, s)) / float(w)).alias("score"), F.lit(int(s)).alias("shard"))
              for s, w in sorted(weights.items())]
    return F.array_min(F.array(*scores))["shard"]


def assign(df: DataFrame, key: str, weights: Mapping[int, float], name: str = "shard") -> DataFrame:
    """``df`` with the shard of each row's key (all columns kept; a column called ``name`` is replaced)."""
    return df.withColumn(name, shard_of(F.col(key), weights))


def dealt(df: DataFrame, shard: str, order: str) -> DataFrame:
    """``df`` (written) with ``_cell`` and ``_sub``: a row's cell within its shard comes from a hash of the order column, and a cell of far
    more than ROWS_PER_CELL rows (an order value that many rows share, null included) is cut into sub-cells by the rows' own numbers."""
    cells = max(1, -(-df.count() // ROWS_PER_CELL))
    number = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col(order).cast("string"), F.lit("")), F.lit(":cell"))), 1, 8), 16, 10)
    rows = kept_table(df.withColumn("_cell", number.cast("bigint") % F.lit(cells)).withColumn("_row", F.monotonically_increasing_id()), "cells")
    full = rows.groupBy(shard, "_cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 2 * ROWS_PER_CELL).select(
        F.col(shard).alias("_full_shard"), F.col("_cell").alias("_full_cell"), F.ceil(F.col("n") / ROWS_PER_CELL).alias("_parts"))
    same = (F.col(shard) == F.col("_full_shard")) & (F.col("_cell") == F.col("_full_cell"))
    sub = F.coalesce(F.pmod(F.xxhash64("_row"), F.col("_parts")), F.lit(0)).cast("int")
    return rows.join(full, same, "left").withColumn("_sub", sub).drop("_full_shard", "_full_cell", "_parts")


def with_slots(df: DataFrame, shard: str, order: str, name: str = "slot") -> DataFrame:
    """Gapless position (from 0) of each row within its shard.

    A shard may hold any number of rows, so it is cut into cells and, where one order value fills a cell, sub-cells (see
    ``dealt``). A row's slot is the rows of earlier ones plus its place in its own. Rows are numbered and written
    first, so that copies of a row can be told apart and keep their places in every later pass.
    """
    marked = dealt(df, shard, order)
    counts = marked.groupBy(shard, "_cell", "_sub").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(shard).orderBy("_cell", "_sub").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(shard).alias("_shard"), F.col("_cell").alias("_start_cell"), F.col("_sub").alias("_start_sub"),
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy(shard, "_cell", "_sub").orderBy(F.col(order).asc_nulls_first(), "_row"))
    placed = marked.withColumn("_place", place)
    joined = placed.join(starts, (F.col(shard) == F.col("_shard")) & (F.col("_cell") == F.col("_start_cell")) & (F.col("_sub") == F.col("_start_sub")))
    return joined.withColumn(name, F.col("_start") + F.col("_place") - 1).select(*[c for c in df.columns if c != name], name)


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Documents over equal shards ``0 .. shards-1`` with the shard each would have if one were added.

    Returns doc_id, size (UTF-8 bytes of the text plus 1; null text: 1), text_crc32 (of the
    UTF-8 bytes; null text: of none, 0), law ('key'), shard, slot, grown_shard. Only ``doc_id``
    and ``text`` are read; other columns, whatever their names, are left out. A null doc_id
    is one more key; rows with equal ids share a shard and have slots of their own. An
    empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    one = {s: 1.0 for s in range(shards)}
    narrow = docs.select(
        "doc_id", (F.octet_length(text).cast("bigint") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"), shard_of(F.col("doc_id"), one).alias("shard"),
        shard_of(F.col("doc_id"), one | {shards: 1.0}).alias("grown_shard"))
    return with_slots(narrow, "shard", "doc_id").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


# DuckDB SQL of ``shard_documents`` over documents; CRC-32 is computed byte by byte from its table.
SHARD_SQL = """
WITH RECURSIVE steps(i, k, c) AS (SELECT i, 0, i FROM range(0, 256) t(i)
    UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END FROM steps WHERE k < 8),
tbl AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
hexed AS (SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS key, octet_length(encode(coalesce(text, ''))) AS bytes,
    regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS h FROM documents),
sums AS (SELECT doc_id, key, bytes, xor(list_reduce(list_prepend(4294967295, list_transform(h, lambda x: CAST('0x' || x AS BIGINT))),
    lambda a, x: xor(a // 256, t[CAST(xor(a, x) % 256 AS BIGINT) + 1])), 4294967295) AS crc FROM hexed, tbl),
scored AS (SELECT *, list_transform(range(0, 9), lambda s: -ln((CAST('0x' || substr(md5(key || ':' || s), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)) AS scores,
    CAST('0x' || substr(md5(key || ':cell'), 1, 8) AS BIGINT) % greatest(1, (SELECT CAST(ceil(count(*) / 20000) AS BIGINT) FROM documents)) AS cell FROM sums),
dealt AS (SELECT *, list_position(scores[1:8], list_min(scores[1:8])) - 1 AS shard, list_position(scores, list_min(scores)) - 1 AS grown FROM scored)
SELECT doc_id, CAST(bytes + 1 AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
    row_number() OVER (PARTITION BY shard ORDER BY cell, doc_id) - 1 AS slot, CAST(grown AS INTEGER) AS grown_shard FROM dealt"""
