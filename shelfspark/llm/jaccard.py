"""N-gram Jaccard join with several global token orders.

Two sets whose similarity is at least t share a token among the first n - ceil(t n) + 1 tokens of each,
under any order of all tokens that both use. Candidates share such a prefix token under the first order, and
before a candidate is counted it must also share one under each further order. All orders put
frequent tokens last (by counts over all documents in a table of fixed size), and differ in how
they order tokens of like frequency.

Two more bounds spare most candidates the shipping of whole sets: what can follow the first shared token in
both sets must be enough, and the token counts per cell of two sets (one byte a token) bound what they share. Where all
pairs of a key are made, the parities of 504 cells bound the difference of two sets in the join itself.

A document's tokens are 64-bit hashes of its five-word shingles. Documents with the same set are one node.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm.common import for_tasks, kept_table, scratch
from shelfspark.llm.hashing import bit_filter, mix, passes, shingle_hashes, signed, text_slices, tidy
from shelfspark.llm.linking import link_members, with_values

SHINGLE = 5
THRESHOLD = Fraction(3, 4)
ORDERS = 3
LOG_CELLS = 22  # a hundred million tokens are a few dozen a cell: rare ones still stand apart
CELL_ROWS = 64
COUNT_GROUPS = 15
TOKEN_BITS = 26
DOCUMENT_BITS = 24
PARITY_GROUPS = 9  # of 7 bytes
ORDERS_AT = 8 + 7 * PARITY_GROUPS
SHORT_PREFIX = 32
ORDER_BYTES = 64  # 16 bits a token
HUB_PAIRS = 1000


def prefix_length(n: np.ndarray | int, t: Fraction):
    """Tokens of a set of n to look at: n - ceil(t n) + 1."""
    return n - -(-n * t.numerator // t.denominator) + 1


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - LOG_CELLS)).astype(np.int64)


def prefix(tokens: np.ndarray, weights: np.ndarray, order: int, t: Fraction) -> np.ndarray:
    """The first tokens of a set in an order: rarer cells first, then by the order's own hash."""
    k = prefix_length(len(tokens), t)
    rank = (weights[_cells(tokens)].astype(np.uint64) << np.uint64(56)) | (mix(tokens, order) >> np.uint64(8))
    first = np.argpartition(rank, k - 1)[:k] if k < len(tokens) else np.arange(len(tokens))
    return tokens[first[np.argsort(rank[first])]]


def set_key(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set of tokens."""
    a, b = mix(tokens, 101).sum(dtype=np.uint64), mix(tokens, 202).sum(dtype=np.uint64)
    both = mix(np.array([a, b], np.uint64) + np.uint64(len(tokens)), 7).view(np.int64)
    return int(both[0]), int(both[1])


_SET_COLUMNS = ["doc_id", "text_hash", "n_shingles", "node", "node2", "cell_row", "cells"]


def _sets(docs: DataFrame) -> DataFrame:
    """Per row doc_id, the text's hash, n_shingles and the set's 128-bit name; and per task the token counts of all cells
    (up to 255, one byte each), in CELL_ROWS rows."""
    schema = docs.select("doc_id").schema.add("text_hash", "long").add("n_shingles", "long").add("node", "long").add("node2", "long").add(
        "cell_row", "integer").add("cells", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << LOG_CELLS, np.uint32)
        kind = None
        for batch in batches:
            kind = batch["doc_id"].type
            for part in text_slices(batch):
                sets = shingle_hashes(part["text"], SHINGLE)
                if sum(map(len, sets)):
                    np.add.at(counts, _cells(np.concatenate(sets)), np.uint32(1))
                keys = [set_key(s) for s in sets]
                none = pa.nulls(len(sets))
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["text_hash"], pa.array(list(map(len, sets)), pa.int64()), pa.array([k[0] for k in keys], pa.int64()),
                     pa.array([k[1] for k in keys], pa.int64()), none.cast(pa.int32()), none.cast(pa.binary())], _SET_COLUMNS)
        if kind is not None:
            rows = [r.tobytes() for r in np.minimum(counts, 255).astype(np.uint8).reshape(CELL_ROWS, -1)]
            none = pa.nulls(CELL_ROWS)
            yield pa.RecordBatch.from_arrays(
                [none.cast(kind), *[none.cast(pa.int64())] * 4, pa.array(range(CELL_ROWS), pa.int32()), pa.array(rows, pa.binary())], _SET_COLUMNS)

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(tidy(run), schema)


def _total(table: pa.Table) -> np.ndarray:
    """Sum of the counts of one row of cells; 1, 2 or 4 bytes a count."""
    total = np.zeros((1 << LOG_CELLS) // CELL_ROWS, np.uint32)
    for x in table["cells"]:
        x = x.as_buffer()
        total += np.frombuffer(x, f"u{len(x) // len(total)}")
    return total


def _weights(parts: DataFrame) -> np.ndarray:
    """Of the partial counts (cell_row, cells): per cell twice the logarithm of its count, as one byte. Summed in two levels."""
    def add(table: pa.Table) -> pa.Table:
        total = _total(table)
        total = total.astype(np.min_scalar_type(int(total.max())))
        return pa.table({"cell_row": table["cell_row"][:1], "cells": pa.array([total.tobytes()], pa.binary())})

    def weigh(table: pa.Table) -> pa.Table:
        out = np.minimum(255, 2 * np.log2(_total(table) + 1.0)).astype(np.uint8)
        return pa.table({"cell_row": table["cell_row"][:1], "cells": pa.array([out.tobytes()], pa.binary())})

    kind = "cell_row int, cells binary"
    some = parts.withColumn("_g", F.pmod(F.monotonically_increasing_id(), F.lit(COUNT_GROUPS))).groupBy("cell_row", "_g").applyInArrow(add, kind)
    weights = np.zeros((CELL_ROWS, (1 << LOG_CELLS) // CELL_ROWS), np.uint8)
    for r in some.groupBy("cell_row").applyInArrow(weigh, kind).collect():
        weights[r["cell_row"]] = np.frombuffer(r["cells"], np.uint8)
    return weights.ravel()


def _prefixes(docs: DataFrame, weights, t: Fraction, shared=None) -> DataFrame:
    """key (token), node, its size and the token's place, for every prefix token under the first order; only tokens that
    pass ``shared`` if given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                sets = [s for s in shingle_hashes(part["text"], SHINGLE) if len(s)]
                if not sets:
                    continue
                firsts = [prefix(s, weights.value, 0, t) for s in sets]
                tokens = np.concatenate(firsts)
                counts = list(map(len, firsts))
                nodes = np.repeat(np.array([set_key(s)[0] for s in sets], np.int64), counts)
                sizes = np.repeat(np.array(list(map(len, sets)), np.int64), counts)
                places = np.arange(len(tokens)) - np.repeat(np.cumsum(counts) - counts, counts)
                if shared is not None:
                    there = passes(shared.value, tokens)
                    tokens, nodes, sizes, places = tokens[there], nodes[there], sizes[there], places[there]
                yield pa.RecordBatch.from_arrays([signed(tokens), pa.array(nodes), pa.array(sizes), pa.array(places)], ["key", "node", "size", "place"])

    return docs.select("text").mapInArrow(tidy(run), "key long, node long, size long, place long")


def _members(docs: DataFrame, weights, t: Fraction) -> DataFrame:
    """Prefix tokens that two different sets at least share, with their sets (written).

    The smaller of two sets that link has their first shared token at a place that leaves 2t / (1 + t) of its own size: only such members are hubs.
    """
    spark = docs.sparkSession
    by_key = lambda rows: rows.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo != hi")
    shared = kept_table(by_key(_prefixes(docs, weights, t)).select("key"), "shared")
    bits = for_tasks(spark, bit_filter(shared, F.col("key"), TOKEN_BITS))
    rows = _prefixes(docs, weights, t, bits).distinct()
    hub = (F.col("size") - F.col("place")) * (t.numerator + t.denominator) >= F.col("size") * 2 * t.numerator
    return kept_table(rows.join(shared, "key").select("key", "node", "size", "place", hub.alias("hub")), "members")


def cell_marks(tokens: np.ndarray) -> bytes:
    """Tokens per cell, one to two tokens a cell: four bits each. Empty if a count needs more."""
    cells = 1 << max(6, (len(tokens) // 2).bit_length())
    counts = np.bincount((tokens & np.uint64(cells - 1)).astype(np.int64), minlength=cells).astype(np.uint8)
    return (counts[::2] | counts[1::2] << 4).tobytes() if counts.max() < 16 else b""


def _counts(marks: bytes) -> np.ndarray:
    packed = np.frombuffer(marks, np.uint8)
    return np.column_stack([packed & 15, packed >> 4]).ravel().astype(np.int64)


def most_common(x: bytes, y: bytes, nx: int, ny: int) -> int:
    """Upper bound of the tokens that two sets share, from their marks."""
    if not x or not y:
        return min(nx, ny)
    x, y = _counts(x), _counts(y)
    cells = min(len(x), len(y))
    return int(np.minimum(x.reshape(-1, cells).sum(axis=0), y.reshape(-1, cells).sum(axis=0)).sum())


def order_bits(tokens: np.ndarray, weights: np.ndarray, t: Fraction, orders: int) -> bytes:
    """A bitmap of the prefix under each further order, ORDER_BYTES each; empty for prefixes of over SHORT_PREFIX tokens."""
    if prefix_length(len(tokens), t) > SHORT_PREFIX:
        return b""
    maps = np.zeros((orders - 1, ORDER_BYTES * 8), np.uint8)
    for k in range(1, orders):
        maps[k - 1, (mix(prefix(tokens, weights, k, t), 300 + k) % np.uint64(ORDER_BYTES * 8)).astype(np.int64)] = 1
    return np.packbits(maps, axis=1).tobytes()


def orders_meet(x: bytes, y: bytes) -> bool:
    """Whether the bitmaps of two sets have a bit in common under every order (sets without bitmaps may)."""
    if not x or not y:
        return True
    both = np.frombuffer(x, np.uint8) & np.frombuffer(y, np.uint8)
    return bool(both.reshape(-1, ORDER_BYTES).any(axis=1).all())


def _scanned(docs: DataFrame, nodes: DataFrame, column: str, make) -> DataFrame:
    """node and ``make`` of its tokens (binary ``column``) for the nodes (doc_id, node) given, and a few more that pass their filter."""
    spark = docs.sparkSession
    wanted = nodes.select(F.xxhash64("doc_id").alias("h"), "node")
    bits = for_tasks(spark, bit_filter(wanted, F.col("h"), DOCUMENT_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(passes(bits.value, batch["h"].to_numpy().astype(np.int64))))
            for part in text_slices(batch):
                sets = shingle_hashes(part["text"], SHINGLE)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_key(s)[0] for s in sets], pa.int64()), pa.array([make(s) for s in sets], pa.binary())], ["node", column])

    return docs.select("text", F.xxhash64("doc_id").alias("h")).mapInArrow(tidy(run), f"node long, {column} binary")


def _marks(docs: DataFrame, nodes: DataFrame, weights, t: Fraction, orders: int) -> DataFrame:
    """node and marks of the nodes (doc_id, node) given (written): size, parities, order bitmaps and cell counts."""
    def marked(tokens: np.ndarray) -> bytes:
        bits = order_bits(tokens, weights.value, t, orders)
        return len(tokens).to_bytes(8, "little") + parities(tokens) + len(bits).to_bytes(2, "little") + bits + cell_marks(tokens)

    found = _scanned(docs, nodes, "marks", marked).join(nodes.select("node"), "node", "left_semi")
    return kept_table(found.groupBy("node").agg(F.first("marks").alias("marks")), "marks")


def parities(tokens: np.ndarray) -> bytes:
    """Whether the number of tokens is odd in each of 504 cells: two sets differ in at least as many tokens as bits."""
    odd = np.bincount((mix(tokens, 77) % np.uint64(PARITY_GROUPS * 56)).astype(np.int64), minlength=PARITY_GROUPS * 56) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _alike(pairs: DataFrame, marks: DataFrame, t: Fraction) -> DataFrame:
    """The pairs whose marks allow a link."""
    def parts(m: bytes) -> tuple[int, bytes, bytes]:
        cells = ORDERS_AT + 2 + int.from_bytes(m[ORDERS_AT:ORDERS_AT + 2], "little")
        return int.from_bytes(m[:8], "little"), m[ORDERS_AT + 2:cells], m[cells:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch["va"].to_pylist(), batch["vb"].to_pylist()):
                (nx, ox, cx), (ny, oy, cy) = parts(x), parts(y)
                both = min(most_common(cx, cy, nx, ny), nx, ny)
                good.append(both * t.denominator >= t.numerator * (nx + ny - both) and orders_meet(ox, oy))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    return kept_table(with_values(pairs, marks, "marks").mapInArrow(tidy(run), "a long, b long"), "alike")


def _linked(docs: DataFrame, pairs: DataFrame, named, t: Fraction) -> DataFrame:
    """The pairs (a, b) whose whole sets link.

    Node a is the hub of its pairs; they are dealt by (a, salt), HUB_PAIRS or so each. A set goes to its own roles first and then, once
    a role, to its hub's place, where the hub's row comes first and the others are compared with it one by one.
    """
    salts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / HUB_PAIRS).cast("int").alias("salts"))
    others = pairs.join(salts, "a").select(F.col("b").alias("node"), "a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), "b")
    hubs = salts.select(F.col("a").alias("node"), "a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("bigint").alias("b"))
    roles = kept_table(others.unionByName(hubs), "roles")
    sets = _scanned(docs, named(roles.select("node").distinct()), "tokens", lambda s: s.tobytes())
    dealt = sets.join(roles, "node").select("a", "salt", "b", "tokens").repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            left, right = [], []
            for a, b, x in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), batch["tokens"]):
                x = np.frombuffer(x.as_buffer(), np.uint64)
                if b is None:
                    hub, own = a, x.copy()
                    continue
                assert a == hub
                both = _common(own, x)
                if both * t.denominator >= t.numerator * (len(own) + len(x) - both):
                    left.append(a)
                    right.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return dealt.mapInArrow(tidy(run), "a long, b long").distinct()


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Number of common values of two ascending arrays of distinct values."""
    if not len(x) or not len(y):
        return 0
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def _classes(docs: DataFrame, t: Fraction, orders: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id of every row, and label: the name of its component (null without words)."""
    spark = docs.sparkSession
    all_sets = kept_table(_sets(docs), "sets-and-counts")
    base = all_sets.filter("cells is null").select("doc_id", "text_hash", "n_shingles", "node", "node2")
    first = kept_table(base.filter("n_shingles > 0").groupBy("node", "node2").agg(F.min("doc_id").alias("doc_id")), "firsts")
    named = lambda nodes: first.join(nodes, "node", "left_semi").select("doc_id", "node")

    # From the first shared token on, at most the rest of either set is shared: t / (1 + t) of both sizes is needed.
    fits = lambda a, b: (F.least(a("size") - a("place"), b("size") - b("place")) * (t.numerator + t.denominator)
                         >= (a("size") + b("size")) * t.numerator)
    group = lambda g: F.conv(F.hex(F.substring("marks", 9 + 7 * g, 7)), 16, 10).cast("bigint").alias(f"odd{g}")

    def alike(a, b):
        differ = sum((F.bit_count(a(f"odd{g}").bitwiseXOR(b(f"odd{g}"))) for g in range(1, PARITY_GROUPS)), F.bit_count(a("odd0").bitwiseXOR(b("odd0"))))
        return differ * (t.numerator + t.denominator) <= (a("size") + b("size")) * (t.denominator - t.numerator)

    with scratch(spark):
        weights = for_tasks(spark, _weights(all_sets.filter("cells is not null").select("cell_row", "cells")))
        members = _members(docs, weights, t)
        marks = _marks(docs, named(members.select("node").distinct()), weights, t, orders)
        test = lambda pairs: _linked(docs, _alike(pairs, marks, t), named, t)
        facts = marks.select("node", *[group(g) for g in range(PARITY_GROUPS)])
        labels = link_members(members, test, fits, facts, alike)
    labelled = first.join(labels, "node", "left").select("node", "node2", "doc_id", F.coalesce("label", "node").alias("label"))
    lowest = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of_set = labelled.join(lowest, "label").select("node", "node2", "label", "component_id")
    linked = base.join(of_set, ["node", "node2"], "left")
    return linked.select("doc_id", "text_hash", "n_shingles", "label",
                         F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def jaccard_classes(docs: DataFrame, t: Fraction = THRESHOLD, orders: int = ORDERS) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id that links reach) of every row.

    A text without words, or null, has an empty set and no links: its component is its own id. Rows of one id are
    each linked by their own text. A null id is never the smallest of a component that has another id; alone it stays
    null. Other columns are left out; an empty table gives an empty result. Hashes of 64 bits stand for shingles and of
    128 bits for sets.
    """
    return _classes(docs, t, orders).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, t: Fraction = THRESHOLD) -> DataFrame:
    """One row of each group of linked documents, with all columns: one with the group's smallest id.

    Of several rows of a group with that id the one with the lowest text hash stays, and of rows that repeat id and text
    any one. A null id comes after all others; rows that share an id, or have none, are no group unless their texts
    link. Rows without words are linked with nothing and all stay.
    """
    with scratch(docs.sparkSession):
        rows = kept_table(_classes(docs, t, ORDERS), "classes", stays=True).filter("n_shingles > 0")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")))
    stays = rows.groupBy("label").agg(first.alias("s")).select(F.col("s.id").alias("_id"), F.col("s.hash").alias("_hash"))
    gone = rows.join(stays, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left_anti")
    repeated = rows.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id", "text_hash")
    repeated = kept_table(repeated, "repeated")
    whole = docs.select(F.struct("*").alias("_doc"), F.xxhash64("text").alias("_key"))
    match = F.col("_doc.doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_hash"))
    named = lambda df: df.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    single = whole.join(named(gone.select("doc_id", "text_hash").unionByName(repeated)), match, "left_anti").select("_doc.*")
    if repeated.isEmpty():
        return single
    left = named(repeated.join(gone, repeated["doc_id"].eqNullSafe(gone["doc_id"]) & (repeated["text_hash"] == gone["text_hash"]), "left_anti"))
    turn = F.row_number().over(Window.partitionBy("_doc.doc_id", "_key").orderBy("_key"))
    once = whole.join(left, match, "left_semi").withColumn("_turn", turn).filter("_turn = 1").select("_doc.*")
    return single.unionByName(once)
