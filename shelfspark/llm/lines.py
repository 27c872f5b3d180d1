"""Near-duplicate lines by a segment-partition edit join.

A line is cut into ``edits + 1`` segments. If another line differs by at most ``edits`` edits, one
segment of the shorter line stands unchanged in the longer one, and only at a few places: left of
segment i lie at most i - 1 edits, right of it at most ``edits + 1 - i``. Segments are indexed by (line length,
segment number, hash) and lines of each length from ``n - edits`` to ``n`` are probed at those places. An edit
touches at most four pairs of neighbouring symbols, so lines whose pairs differ in parity in more than four classes an
edit are not paired. What is left is verified by a banded bit-parallel edit distance over code points.

Lines that are linked, directly or through others, are one class; equal lines are one node. The first line
of a class (lowest doc_id, then line number) stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import NON_SPACE, for_tasks, kept_table, let, scratch
from shelfspark.llm.hashing import Segments, bit_filter, mix, passes, signed, text_slices, tidy
from shelfspark.llm.linking import link_members, with_values

EDITS = 2
SHORTEST = 12  # shorter lines are alike only if equal
INDEX_BITS = 26
SHARED_BITS = 25
NODE_BITS = 24
CLASSES = 64

_symbols: list[np.ndarray] = []


def _symbol_values() -> np.ndarray:
    if not _symbols:
        _symbols.append(mix(np.arange(0x110000, dtype=np.uint64), 17) | np.uint64(1))
    return _symbols[0]


def _lines(texts: pa.Array) -> pa.Array:
    """The distinct lines of the texts that are long enough for the edit join and not blank."""
    flat = pc.split_pattern(texts.fill_null(""), "\n").flatten().unique()
    return flat.filter(pc.and_(pc.greater_equal(pc.utf8_length(flat), SHORTEST), pc.match_substring_regex(flat, NON_SPACE)))


def _nodes(lines: pa.Array) -> np.ndarray:
    """xxhash64 of each line as Spark computes it."""
    return np.array([xxhash.xxh64_intdigest(x, 42) for x in lines.cast(pa.binary()).to_pylist()], np.uint64).view(np.int64)


class _Segmented:
    """Keys of the segments of lines: what they are indexed by, and what they probe."""

    def __init__(self, lines: pa.Array, edits: int):
        self.lengths = pc.utf8_length(lines).to_numpy().astype(np.int64)
        symbols = np.frombuffer("".join(lines.to_pylist()).encode("utf-32-le", "surrogatepass"), "<u4")
        self.segments = Segments(_symbol_values()[symbols])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.edits = edits
        # Class of each pair of neighbouring symbols (the last symbol of a line has none).
        values = _symbol_values()[symbols]
        self.classes = (mix(values[:-1] * np.uint64(3) + values[1:], 41) >> np.uint64(58)).astype(np.int64)

    def parities(self) -> np.ndarray:
        """Whether each class of symbol pairs occurs an odd number of times in each line, one bit a class."""
        row = np.repeat(np.arange(len(self.lengths)), self.lengths)
        inner = row[:-1] == row[1:]
        odd = np.bincount((row[:-1] * CLASSES + self.classes)[inner], minlength=len(self.lengths) * CLASSES).reshape(-1, CLASSES) & 1
        return (odd.astype(np.uint64) << np.arange(CLASSES, dtype=np.uint64)).sum(axis=1, dtype=np.uint64).view(np.int64)

    def _cut(self, lengths: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Place and size of segment i of lines of the given lengths: sizes differ by one at most, longer ones last."""
        parts = self.edits + 1
        size, longer = lengths // parts, lengths % parts
        place = i * size + np.maximum(0, i - (parts - longer))
        return place, size + (i >= parts - longer)

    def _key(self, at: np.ndarray, size: np.ndarray, lengths: np.ndarray, i: int) -> np.ndarray:
        return mix(self.segments.hashes(at, at + size) ^ mix((lengths * 64 + i).astype(np.uint64), 23), 29)

    def index(self) -> Iterator[np.ndarray]:
        for i in range(self.edits + 1):
            place, size = self._cut(self.lengths, i)
            yield self._key(self.starts + place, size, self.lengths, i)

    def probes(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, keys) of the substrings to look for in the index, without each line's own segments."""
        for delta in range(self.edits + 1):
            rows = np.flatnonzero(self.lengths - delta >= SHORTEST)
            lengths = self.lengths[rows] - delta
            for i in range(self.edits + 1):
                place, size = self._cut(lengths, i)
                before, after = i, self.edits - i  # edits that may lie on either side
                for shift in range(max(-before, delta - after), min(before, delta + after) + 1):
                    if delta == 0 and shift == 0:
                        continue
                    at = place + shift
                    fits = (at >= 0) & (at + size <= self.lengths[rows])
                    yield rows[fits], self._key((self.starts[rows] + at)[fits], size[fits], lengths[fits], i)


def within(a: np.ndarray, b: np.ndarray, edits: int) -> bool:
    """Whether two symbol arrays differ by at most ``edits`` insertions, deletions and replacements.

    Equal ends are cut off. Then, for each number of edits, one integer holds the diagonals (2 * edits + 1 of them)
    that can be reached, and all diagonals advance at once.
    """
    if abs(len(a) - len(b)) > edits:
        return False
    for step in (1, -1):
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[::step][:n] != b[::step][:n])
        same = int(differ[0]) if len(differ) else n
        a, b = (a[same:], b[same:]) if step == 1 else (a[:len(a) - same], b[:len(b) - same])
    if not len(a) or not len(b):
        return True  # what is left of the other one is no longer than the difference of lengths
    match = np.zeros(len(a), np.int64)
    for d in range(2 * edits + 1):
        shift = d - edits
        lo, hi = max(0, -shift), min(len(a), len(b) - shift)
        if lo < hi:
            match[lo:hi] |= (a[lo:hi] == b[lo + shift:hi + shift]).astype(np.int64) << d
    band = (1 << (2 * edits + 1)) - 1
    reach = [((1 << (e + 1)) - 1) << edits for e in range(edits + 1)]
    for m in match.tolist():
        below = 0  # what one edit less reaches, before and after this symbol
        fewer = 0
        for e, r in enumerate(reach):
            now = (r & m) | below | (below >> 1) | (fewer << 1)
            below, fewer = r, now & band
            reach[e] = fewer
        if not fewer:
            return False
    return bool(reach[edits] >> (len(b) - len(a) + edits) & 1)


def _index_keys(docs: DataFrame, edits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                lines = _lines(part["text"])
                if len(lines):
                    yield pa.RecordBatch.from_arrays([signed(np.concatenate(list(_Segmented(lines, edits).index())))], ["key"])

    return docs.select("text").mapInArrow(tidy(run), "key long")


def _keys(docs: DataFrame, edits: int, indexed, shared=None) -> DataFrame:
    """key, node, size, place (parities), hub: all index keys (hub) and the probes that the index may hold; only keys
    that pass ``shared`` if given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                lines = _lines(part["text"])
                if not len(lines):
                    continue
                nodes, segmented = _nodes(lines), _Segmented(lines, edits)
                found = [(np.arange(len(nodes)), key, True) for key in segmented.index()]
                for rows, key in segmented.probes():
                    there = passes(indexed.value, key)
                    found.append((rows[there], key[there], False))
                row, key = np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])
                hub = np.repeat([x[2] for x in found], [len(x[1]) for x in found])
                if shared is not None:
                    there = passes(shared.value, key)
                    row, key, hub = row[there], key[there], hub[there]
                place = segmented.parities()[row] if shared is not None else np.zeros(len(row), np.int64)
                yield pa.RecordBatch.from_arrays([signed(key), pa.array(nodes[row]), pa.array(segmented.lengths[row]), pa.array(place), pa.array(hub)],
                                                 ["key", "node", "size", "place", "hub"])

    return docs.select("text").mapInArrow(tidy(run), "key long, node long, size long, place long, hub boolean")


def _members(docs: DataFrame, edits: int) -> DataFrame:
    """Keys that two lines share, one of them by its index, with their lines (written)."""
    spark = docs.sparkSession
    indexed = for_tasks(spark, bit_filter(_index_keys(docs, edits), F.col("key"), INDEX_BITS))
    per_key = _keys(docs, edits, indexed).groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.max("hub").alias("hub"))
    shared = kept_table(per_key.filter("lo != hi and hub").select("key"), "shared")
    bits = for_tasks(spark, bit_filter(shared, F.col("key"), SHARED_BITS))
    rows = _keys(docs, edits, indexed, bits).groupBy("key", "node", "size", "place").agg(F.max("hub").alias("hub"))
    return kept_table(rows.join(shared, "key").select("key", "node", "size", "place", "hub"), "members")


def _line_table(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and line of the nodes given."""
    bits = for_tasks(docs.sparkSession, bit_filter(nodes, F.col("node"), NODE_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                lines = _lines(part["text"])
                node = _nodes(lines)
                there = passes(bits.value, node) if len(node) else np.zeros(0, bool)
                yield pa.RecordBatch.from_arrays([pa.array(node[there]), lines.filter(pa.array(there))], ["node", "line"])

    found = docs.select("text").mapInArrow(tidy(run), "node long, line string").join(nodes, "node", "left_semi")
    return kept_table(found.groupBy("node").agg(F.first("line").alias("line")), "lines")


def _verify(pairs: DataFrame, lines: DataFrame, edits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = lambda s: np.frombuffer(s.encode("utf-32-le", "surrogatepass"), "<u4")
        for b in batches:
            good = [within(symbols(x), symbols(y), edits) for x, y in zip(b["va"].to_pylist(), b["vb"].to_pylist())]
            yield pa.RecordBatch.from_arrays([b["a"], b["b"]], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    return with_values(pairs, lines, "line").mapInArrow(tidy(run), "a long, b long")


def line_rows(docs: DataFrame) -> DataFrame:
    """doc_id, row (hash of id and text), line_no (from 0) and node (hash) of every line that has a word."""
    lines = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.filter(F.col("line").rlike(NON_SPACE)).select("doc_id", "row", "line_no", F.xxhash64("line").alias("node"))


def line_classes(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """doc_id, row, line_no, first_doc_id, first_line_no (the first line of its class) and kept of every line with a word.

    Lines of fewer than SHORTEST code points, and lines that nothing is linked to, are alone or with their equals.
    Null and empty texts have no lines; blank lines belong to no class. A null id comes first. Rows that repeat id
    and text are one document to this rule. An empty table gives an empty result.
    """
    fits = lambda a, b: (F.abs(a("size") - b("size")) <= edits) & (
        F.bit_count(a("place").bitwiseXOR(b("place"))) <= 4 * edits)
    with scratch(docs.sparkSession):
        members = _members(docs, edits)
        lines = _line_table(docs, members.select("node").distinct())
        labels = link_members(members, lambda pairs: _verify(pairs, lines, edits), fits)
    rows = line_rows(docs).join(labels, "node", "left").select("doc_id", "row", "line_no", F.coalesce("label", "node").alias("label"))
    first = rows.groupBy("label").agg(F.min(F.struct("doc_id", "line_no", "row")).alias("f"))
    kept = F.col("doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("line_no") == F.col("f.line_no")) & (F.col("row") == F.col("f.row"))
    return rows.join(first, "label").select("doc_id", "row", "line_no", F.col("f.doc_id").alias("first_doc_id"),
                                            F.col("f.line_no").alias("first_line_no"), kept.alias("kept"))


def line_report(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """``line_classes`` of whole documents without the row hash: one row per line with a word."""
    return line_classes(docs, edits).drop("row")


def drop_lines(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """The documents without the lines that are not the first of their class, with all their columns.

    Blank lines stay where they are. A document that loses every line with a word is dropped; one that
    never had any stays. Other columns keep their values. Rows that repeat id and text are treated alike.
    """
    gone = line_classes(docs, edits).filter("not kept").groupBy(F.col("doc_id").alias("_id"), F.col("row").alias("_row")).agg(
        F.collect_set("line_no").alias("_gone"))
    whole = docs.select(F.struct("*").alias("_doc"), F.xxhash64("doc_id", "text").alias("_key"))
    marked = whole.join(gone, F.col("_doc.doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_row")), "left")
    left = let(F.col("_gone"), lambda g: F.filter(F.split("_doc.text", "\n"), lambda x, i: ~F.array_contains(g, i)))
    text = F.when(F.col("_gone").isNull(), F.col("_doc.text")).otherwise(F.array_join(left, "\n"))
    cleaned = marked.withColumn("_left", text).filter(F.col("_gone").isNull() | F.col("_left").rlike(NON_SPACE))
    return cleaned.select(F.col("_doc").withField("text", F.col("_left")).alias("_doc")).select("_doc.*")
