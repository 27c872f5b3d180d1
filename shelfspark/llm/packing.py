"""Best-fit packing of token sequences in bulk-synchronous rounds.

Documents are cut into pieces of at most ``capacity`` tokens. Pieces over half the
capacity open a sequence each. Then, in rounds over all remaining pieces and
all gaps: both are ranked by size, and a sweep over the sizes pairs every gap with the
largest free piece that fits (the successor of a piece is the smallest gap that holds it;
pieces and gaps of equal size pair off by rank, which settles conflicts). Gaps shrink by
what they took. If what is left cannot fit into the gaps, the largest pieces open as
many sequences as the missing room needs. Rounds repeat until nothing is left.

The sweep itself needs only the number of pieces and gaps of each size (at most ``2 *
capacity * SALTS`` counts, a bound set by the parameter). From the counts every row learns a stack
level: pieces push ascending levels, gaps pop descending ones, and a piece and the gap that
takes it are neighbours on one level. Ranks within a size are counted per (size, salt), so
that a size shared by a third of all pieces is dealt over several tasks. Each round is written
to the checkpoint folder.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.llm.common import sized, table_writes, written
from shelfspark.llm.hashing import tidy
from shelfspark.llm.token_counts import default_tokenizer
from shelfspark.llm.wordids import encoder, slices

CAPACITY = 2048
END_ID = 0
SALTS = 8
ROWS_PER_PARTITION = 100_000
PIECE, GAP = 0, 1


def _pieces(text: pa.Array, path: str, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All ids (each text's followed by END_ID), and of each piece: row, number, first id in the row, length."""
    ids, starts = encoder(path).encode(text)
    n = np.diff(starts) + 1
    flat = np.insert(ids, starts[1:], END_ID).astype("<u4")
    pieces = -(-n // capacity)
    row = np.repeat(np.arange(len(n)), pieces)
    number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = number * capacity
    return flat, row, number, start, np.minimum(capacity, n[row] - start)


def document_pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of each document's pieces. Null text has only the end id."""
    path = tokenizer or default_tokenizer()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                flat, row, number, start, length = _pieces(part["text"], path, capacity)
                ends = np.cumsum(length)
                raw = memoryview(flat.tobytes())
                crc = [zlib.crc32(raw[4 * (e - k):4 * e]) for e, k in zip(ends.tolist(), length.tolist())]
                columns = [part["doc_id"].take(pa.array(row)), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                           pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema])

    schema = docs.select("doc_id").schema.add("piece", "integer").add("start", "long").add("length", "long").add("ids_crc32", "long")
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    return docs.select("doc_id", "text").mapInArrow(tidy(cut), schema)


def _sweep(counts: dict[tuple[int, int, int], int]) -> tuple[list[tuple], int, dict[str, int]]:
    """Of the counts by (size, kind, salt): for each, the rows of its size in earlier salts and the stack depth
    before its size; the depth at the end (pieces without a gap); what was matched and is left."""
    by_size: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for (size, kind, salt), n in counts.items():
        by_size.setdefault((size, kind), []).append((salt, n))
    table, depth, matched, stack = [], 0, 0, []
    for size, kind in sorted(by_size):  # pieces come before gaps of their size, for they fit
        before = 0
        for salt, n in sorted(by_size[size, kind]):
            table.append((size, kind, salt, before, depth))
            before += n
        if kind == PIECE:
            depth += before
            stack.append([size, before])
        else:
            taken = min(before, depth)
            depth, matched = depth - taken, matched + taken
            while taken:  # the top of the stack goes first
                k = min(taken, stack[-1][1])
                stack[-1][1] -= k
                taken -= k
                if not stack[-1][1]:
                    stack.pop()
    left = sum(size * n for size, n in stack)
    pieces = sum(size * n for (size, kind, _), n in counts.items() if kind == PIECE)
    room = sum(size * n for (size, kind, _), n in counts.items() if kind == GAP) - (pieces - left)
    return table, depth, {"matched": matched, "left": left, "room": room}


def _row(tag: str, i: Column, size: Column, where: Column | None = None, offset: Column | None = None) -> Column:
    null = F.lit(None).cast("bigint")
    return F.struct(F.lit(tag).alias("tag"), i.alias("id"), size.cast("bigint").alias("size"),
                    (null if where is None else where).alias("bin"), (null if offset is None else offset.cast("bigint")).alias("offset"))


def _unfold(df: DataFrame, *rows: Column) -> DataFrame:
    return df.select(F.explode(F.array(*rows)).alias("x")).filter("x is not null").select("x.*")


def _deal(ranked: DataFrame, left: int, sequences: int, capacity: int) -> DataFrame:
    """No gap takes any piece: all pieces, the largest first, are dealt over new sequences in turn; a sequence keeps
    those that come before it is full, the others wait."""
    order = F.lit(left) - F.col("depth") - F.col("rank")
    pieces = ranked.filter(F.col("kind") == PIECE).select("id", "size", order.alias("order"))
    w = Window.partitionBy(F.col("order") % sequences).orderBy("order")
    dealt = pieces.select("id", "size", F.first("id").over(w).alias("bin"), F.sum("size").over(w).alias("upto"), F.lead("size").over(w).alias("then"))
    goes_in = F.col("upto") <= capacity
    last = goes_in & F.coalesce(F.col("upto") + F.col("then") > capacity, F.lit(True)) & (F.col("upto") < capacity)
    fresh = _unfold(dealt, F.when(goes_in, _row("placed", F.col("id"), F.col("size"), F.col("bin"), F.col("upto") - F.col("size"))).otherwise(
        _row("piece", F.col("id"), F.col("size"))), F.when(last, _row("gap", F.col("bin"), F.lit(capacity) - F.col("upto"))))
    return fresh.unionByName(_unfold(ranked.filter(F.col("kind") == GAP), _row("gap", F.col("id"), F.col("size"))))


def _round(spark: SparkSession, rows: DataFrame, capacity: int) -> tuple[DataFrame, int] | None:
    """One round over rows (kind, id, size): rows tagged 'placed', 'gap' or 'piece', and how many came in. None if no piece is left."""
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    counts = {(r["size"], r["kind"], r["salt"]): r["n"] for r in rows.groupBy("size", "kind", "salt").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not any(kind == PIECE for _, kind, _ in counts):
        return None
    table, left, sums = _sweep(counts)
    ranks = spark.createDataFrame(table, "size bigint, kind int, salt int, before bigint, depth bigint")
    cell = Window.partitionBy("size", "kind", "salt").orderBy("id")
    ranked = rows.join(F.broadcast(ranks), ["size", "kind", "salt"]).withColumn("rank", F.col("before") + F.row_number().over(cell))
    if not sums["matched"]:
        return _deal(ranked, left, max(1, -(-sums["left"] // capacity)), capacity), sum(counts.values())
    opened = max(0, -(-(sums["left"] - sums["room"]) // capacity))
    is_piece = F.col("kind") == PIECE
    level = F.when(is_piece, F.col("depth") + F.col("rank")).otherwise(F.col("depth") - F.col("rank") + 1)
    levelled = ranked.select("kind", "id", "size", F.when(level >= 1, level).otherwise(-1 - F.col("id")).alias("level"))
    w = Window.partitionBy("level").orderBy("size", "kind")
    paired = levelled.withColumn("after", F.lead(F.struct("kind", "id", "size")).over(w)).withColumn("prior", F.lag(F.struct("kind", "size")).over(w))
    fits = is_piece & F.coalesce(F.col("after.kind") == GAP, F.lit(False))
    opens = is_piece & ~fits & (F.lit(left) - F.col("level") < opened)  # the piece that waits on the top level is the largest
    rest = F.col("size") - F.when(F.col("prior.kind") == PIECE, F.col("prior.size")).otherwise(0)
    after = _unfold(
        paired,
        F.when(fits, _row("placed", F.col("id"), F.col("size"), F.col("after.id"), F.lit(capacity) - F.col("after.size")))
        .when(opens, _row("placed", F.col("id"), F.col("size"), F.col("id"), F.lit(0)))
        .when(is_piece, _row("piece", F.col("id"), F.col("size")))
        .when(rest > 0, _row("gap", F.col("id"), rest)),
        F.when(opens, _row("gap", F.col("id"), F.lit(capacity) - F.col("size"))))
    return after, sum(counts.values())


def best_fit(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """id, bin, offset of each piece of ``pieces`` (id unique and not negative, size from 1 to capacity)."""
    spark = pieces.sparkSession
    big = F.col("size") * 2 > capacity
    state = pieces.filter(~big).select(F.lit(PIECE).alias("kind"), "id", "size").unionByName(
        pieces.filter(big & (F.col("size") < capacity)).select(F.lit(GAP).alias("kind"), "id", (F.lit(capacity) - F.col("size")).alias("size")))
    placed = [pieces.filter(big).select("id", F.col("id").alias("bin"), F.lit(0).cast("bigint").alias("offset"))]
    with table_writes(spark):
        while (done := _round(spark, state, capacity)) is not None:
            after = written(sized(*done, ROWS_PER_PARTITION))
            placed.append(after.filter("tag = 'placed'").select("id", "bin", "offset"))
            state = after.filter("tag != 'placed'").select(F.when(F.col("tag") == "gap", GAP).otherwise(PIECE).alias("kind"), "id", "size")
    return reduce(DataFrame.unionByName, placed)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """Every piece of every document with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one piece with only the end id. Repeated rows and equal or null ids are packed
    row by row. Other columns are left out; an empty table gives an empty result.
    """
    pieces = written(document_pieces(docs, capacity, tokenizer).withColumn("_id", F.monotonically_increasing_id()))
    places = best_fit(pieces.select(F.col("_id").alias("id"), F.col("length").alias("size")), capacity)
    return pieces.join(places, F.col("_id") == F.col("id")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset")


def packed_sequences(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """The sequences themselves: sequence_id and its token ids (at most ``capacity``), pieces in their order."""
    pieces = written(document_pieces(docs, capacity, tokenizer, with_ids=True).withColumn("_id", F.monotonically_increasing_id()))
    places = best_fit(pieces.select(F.col("_id").alias("id"), F.col("length").alias("size")), capacity)
    parts = pieces.join(places, F.col("_id") == F.col("id")).groupBy(F.col("bin").alias("sequence_id")).agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("_p"))
    return parts.select("sequence_id", F.flatten(F.col("_p.ids")).alias("ids"))
