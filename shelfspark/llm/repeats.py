"""Removal of byte strings that start at two places or more, by a depth-limited radix sort of suffixes.

Suffixes are ordered only through their first ``depth`` bytes, by most-significant-digit passes;
a group that ends with one suffix drops out of the later passes, and groups that are
equal through the whole depth are exactly the repeated windows.

First digit. Every window of ``depth`` bytes names an anchor: the place in it whose
``3 * depth // 4`` bytes have the lowest hash (the first of them). Equal windows name equal anchors at
equal offsets, so windows are grouped by their anchor's bytes, one row per anchor instead
of one per window. Anchors whose bytes occur once drop out.

Second digit. An anchor's windows all lie in its surroundings (the bytes its windows
cover). Anchors with equal bytes and equal surroundings repeat in every window at once. What
remains are groups with different surroundings.

Last pass. One anchor of each kind of such a group gives its single windows, which are grouped
by all their bytes. Hashes stand for the digits, 96 bits in all: a group is equal in the 64 bits of its anchor and 32 of its
surroundings, or in the 64 bits of its window and 32 of its anchor.

The same passes over words (runs of non-blank bytes, one symbol each) find windows of ``depth`` words that start at two
places, whatever their length in bytes and the blanks between them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import NON_SPACE, for_tasks, kept_table, scratch
from shelfspark.llm.hashing import _SPACE, Segments, bit_filter, buffers, byte_values, mix, passes, signed, text_slices, tidy

DEPTH = 400
PASSAGE_WORDS = 51
BYTES, WORDS = "bytes", "words"
ANCHOR_BITS = 26
PLACE_BITS = 26
SCAN_BYTES = 64 << 10  # a scan holds some twenty arrays of 8 bytes a byte of text: these stay small, and in the processor's cache


def _anchors(lengths: np.ndarray, offsets: np.ndarray, segments: Segments, depth: int) -> tuple[np.ndarray, ...]:
    """Of a batch: anchor place, its first and last window's start (places in the batch), the hash of its
    bytes and of its surroundings; and the text each lies in."""
    k = 3 * depth // 4
    span = depth - k + 1  # anchors a window chooses from
    total = int(offsets[-1])
    if lengths.max(initial=0) < depth:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),)
    places = np.arange(total - k + 1)
    rank = (segments.hashes(places, places + k) & ~np.uint64((1 << 26) - 1)) | (places.astype(np.uint64) & np.uint64((1 << 26) - 1))
    # Lowest rank of each run of ``span`` places: suffix minima of one block and prefix minima of the next.
    blocks = -(-len(rank) // span)
    padded = np.full(blocks * span, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(rank)] = rank
    grid = padded.reshape(blocks, span)
    to_end = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    from_start = np.minimum.accumulate(grid, axis=1).ravel()
    starts = np.concatenate([np.arange(o, o + n - depth + 1) for o, n in zip(offsets[:-1].tolist(), lengths.tolist()) if n >= depth])
    low = np.minimum(to_end[starts], from_start[starts + span - 1])
    anchor = starts - (starts & ((1 << 26) - 1)) + (low & np.uint64((1 << 26) - 1)).astype(np.int64)
    anchor[anchor < starts] += 1 << 26
    text = np.repeat(np.arange(len(lengths)), np.maximum(lengths - depth + 1, 0))
    # Runs of windows with one anchor (and within one text).
    edge = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | (starts[1:] != starts[:-1] + 1)]) if len(starts) else np.zeros(0, bool))
    at, lo, doc = anchor[edge], starts[edge], text[edge]
    hi = starts[np.concatenate([edge[1:] - 1, [len(starts) - 1]])] if len(edge) else lo
    around = segments.hashes(lo, hi + depth) ^ mix((at - lo).astype(np.uint64), 3)
    # Anchors have the lowest hashes, so their keys are spread over all values again.
    return at, lo, hi, mix(segments.hashes(at, at + k), 31), around, doc


def _word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a batch's texts start and end (places in the batch)."""
    space = np.concatenate([[True], _SPACE[data], [True]])
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    inside = ~space[1:-1]
    return np.flatnonzero(inside & (space[:-2] | edge[:-1])), np.flatnonzero(inside & (space[2:] | edge[1:])) + 1


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    return text_slices(batch, most=SCAN_BYTES)


def _scan(part: pa.RecordBatch, depth: int, unit: str):
    """Where each text's symbols start, their segments and their anchors."""
    data, offsets = buffers(part["text"])
    segments = Segments(byte_values(data))
    if unit == WORDS:
        starts, ends = _word_bounds(data, offsets)
        segments, offsets = Segments(segments.hashes(starts, ends)), np.searchsorted(starts, offsets)
    return offsets, segments, _anchors(np.diff(offsets), offsets, segments, depth)


def _short(x: np.ndarray) -> pa.Array:
    """The upper half of 64-bit hashes."""
    return pa.array((x >> np.uint64(32)).astype(np.uint32).view(np.int32))


def _place_key(row: np.ndarray, place: np.ndarray) -> np.ndarray:
    return mix(row.view(np.uint64) ^ mix(place.astype(np.uint64), 11), 5)


def _source(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")


def _anchor_keys(docs: DataFrame, depth: int, unit: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                yield pa.RecordBatch.from_arrays([signed(_scan(part, depth, unit)[2][3])], ["key"])

    return docs.select("text").mapInArrow(tidy(run), "key long")


def _shared_anchors(docs: DataFrame, depth: int, unit: str, bits) -> DataFrame:
    """key, around (32 bits), row, and within the text: lo, hi (the first and last window) of the anchors that pass the filter.

    A text's anchors have windows of their own, so (row, lo) names one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                offsets, _, (at, lo, hi, key, around, doc) = _scan(part, depth, unit)
                keep = passes(bits.value, key)
                lo, hi, key, around, doc = (x[keep] for x in (lo, hi, key, around, doc))
                row = part["row"].to_numpy()[doc]
                base = offsets[doc]
                yield pa.RecordBatch.from_arrays([signed(key), _short(around), pa.array(row), pa.array((lo - base).astype(np.int32)), pa.array((hi - base).astype(np.int32))],
                                                 ["key", "around", "row", "lo", "hi"])

    return _source(docs).select("row", "text").mapInArrow(tidy(run), "key long, around int, row long, lo int, hi int")


def _windows(docs: DataFrame, depth: int, unit: str, rows, places, again=None) -> DataFrame:
    """window (hash of its symbols), key (of its anchor, 32 bits), row, start of every window of the anchors whose row and (row, place)
    pass the filters; only windows that pass ``again`` if given. Equal windows have equal anchors, so both hashes name a window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(passes(rows.value, batch["row"].to_numpy())))
            for part in _slices(batch):
                offsets, segments, (at, lo, hi, key, _, doc) = _scan(part, depth, unit)
                row = part["row"].to_numpy()
                keep = passes(places.value, _place_key(row[doc], lo - offsets[doc]))
                lo, n, doc, key = lo[keep], (hi - lo + 1)[keep], doc[keep], key[keep]
                starts = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
                text, key = np.repeat(doc, n), np.repeat(key, n)
                window = segments.hashes(starts, starts + depth)
                if again is not None:
                    there = passes(again.value, window)
                    starts, text, window, key = starts[there], text[there], window[there], key[there]
                yield pa.RecordBatch.from_arrays([signed(window), _short(key), pa.array(row[text]), pa.array((starts - offsets[text]).astype(np.int32))],
                                                 ["window", "key", "row", "start"])

    return _source(docs).select("row", "text").mapInArrow(tidy(run), "window long, key int, row long, start int")


def repeated_spans(docs: DataFrame, depth: int = DEPTH, unit: str = BYTES) -> DataFrame:
    """row, spans: per text (xxhash64 of id and text) an array of (from, to) ranges of its bytes or words whose union repeats elsewhere (written)."""
    with scratch(docs.sparkSession):
        return kept_table(_repeated(docs, depth, unit), f"{unit}-spans", stays=True)


def _repeated(docs: DataFrame, depth: int, unit: str) -> DataFrame:
    spark = docs.sparkSession
    twice = _anchor_keys(docs, depth, unit).groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    bits = for_tasks(spark, bit_filter(twice, F.col("key"), ANCHOR_BITS))
    anchors = kept_table(_shared_anchors(docs, depth, unit, bits), "anchors")
    kinds = kept_table(anchors.groupBy("key", "around").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "lo")).alias("one")), "kinds")
    whole = anchors.join(kinds.filter("n > 1").select("key", "around"), ["key", "around"], "left_semi").select(
        "row", F.col("lo").cast("bigint").alias("from"), (F.col("hi").cast("bigint") + depth).alias("to"))
    mixed = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("key")
    ones = kept_table(kinds.join(mixed, "key", "left_semi").select("one.row", "one.lo"), "ones")
    places = for_tasks(spark, bit_filter(_place_keys(ones), F.col("place_key"), PLACE_BITS))
    rows = for_tasks(spark, bit_filter(ones, F.col("row"), PLACE_BITS))
    windows = _windows(docs, depth, unit, rows, places)
    again = kept_table(windows.groupBy("window", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("window", "key"), "again")
    more = for_tasks(spark, bit_filter(again, F.col("window"), PLACE_BITS))
    single = _windows(docs, depth, unit, rows, places, more).join(again, ["window", "key"], "left_semi").select(
        "row", F.col("start").cast("bigint").alias("from"), (F.col("start").cast("bigint") + depth).alias("to"))
    return whole.unionByName(single).groupBy("row").agg(F.collect_set(F.struct("from", "to")).alias("spans"))


def _place_keys(ones: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([signed(_place_key(b["row"].to_numpy(), b["lo"].to_numpy()))], ["place_key"])

    return ones.select("row", "lo").mapInArrow(tidy(run), "place_key long")


def _filtered(df: DataFrame, column: str, bits) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(passes(bits.value, b[column].to_numpy().astype(np.int64))))

    return df.mapInArrow(tidy(run), df.schema)


def _kept(text: bytes, spans) -> tuple[list[bytes], int, int]:
    """What is left of the text around the spans, the bytes removed, and the number of removed runs."""
    if not spans:
        return [text], 0, 0
    parts, end, runs, removed = [], 0, 0, 0
    last = -1
    for a, b in sorted((s["from"], s["to"]) for s in spans):
        if a > last:
            parts.append(text[end:a])
            runs += 1
            removed += b - a
        elif b > last:
            removed += b - last
        end = last = max(last, b)
    parts.append(text[end:])
    return parts, removed, runs


def _all_spans(docs: DataFrame, depth: int, words: int | None) -> DataFrame:
    """row, spans (of bytes) and words (spans of words; null without ``words``) of every text that has any."""
    if words is None:
        return repeated_spans(docs, depth).withColumn("words", F.lit(None).cast("array<struct<from:bigint,to:bigint>>"))
    with scratch(docs.sparkSession):
        of_words = repeated_spans(docs, words, WORDS).withColumnRenamed("spans", "words")
        return kept_table(repeated_spans(docs, depth).join(of_words, "row", "full"), "spans", stays=True)


def _in_two(docs: DataFrame, spans: DataFrame, columns: list[str], run, schema) -> DataFrame:
    """``run`` over batches of (key, text, columns..., spans, words): texts that have no span are not shuffled.

    A filter of fixed size tells most of them; the others are joined to their spans.
    """
    bits = for_tasks(docs.sparkSession, bit_filter(spans, F.col("row"), PLACE_BITS))

    def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def others() -> Iterator[pa.RecordBatch]:
            for b in batches:
                b = b.filter(pa.array(~passes(bits.value, b["key"].to_numpy())))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.nulls(len(b)), pa.nulls(len(b))], [*b.schema.names, "spans", "words"])

        yield from run(others())

    source = docs.select(F.xxhash64("doc_id", "text").alias("key"), "text", *columns)
    joined = _filtered(source, "key", bits).join(spans, F.col("key") == F.col("row"), "left").drop("row")
    return source.mapInArrow(tidy(without), schema).unionByName(joined.mapInArrow(tidy(run), schema))


def repeat_report(docs: DataFrame, depth: int = DEPTH, words: int = PASSAGE_WORDS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row's UTF-8 bytes; n_passage_bytes, n_passage_spans, text.

    The first ones tell of byte strings of ``depth`` that start at two places and of them only. Passages of ``words``
    words that start at two places, whatever their bytes, are counted by n_passage_bytes and n_passage_spans, and
    text is what is left without either (as ``drop_repeats`` leaves it; a null text stays null).

    Null text counts as empty. A text shorter than ``depth`` and ``words`` loses nothing. Rows that repeat id and text are
    two texts, and each loses all bytes if long enough. Other columns are left out; an empty table gives an empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans, passages in zip(batch["text"], batch["spans"], batch["words"]):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                spans, passages = spans.as_py() or [], passages.as_py() or []
                passages = _in_bytes(raw, passages) if passages else []
                parts, removed, runs = _kept(raw, spans)
                _, more, places = _kept(raw, passages)
                left = _text_of(raw, spans + passages) if spans or passages else text.as_py()
                out.append((len(raw), removed, runs, hashlib.sha256(b"".join(parts)).hexdigest(), more, places, left))
            columns = list(zip(*out)) if out else [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *[pa.array(c, k) for c, k in zip(columns, kinds)]], _REPORT)

    schema = docs.select("doc_id").schema
    for name in _REPORT[1:]:
        schema = schema.add(name, "string" if name in ("kept_sha256", "text") else "long")
    return _in_two(docs.select("doc_id", "text"), _all_spans(docs, depth, words), ["doc_id"], run, schema)


_REPORT = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_bytes", "n_passage_spans", "text"]


def _text_of(raw: bytes, spans: list) -> str:
    """The text without the spans; a character that is cut goes as a whole."""
    return "".join(p.decode("utf-8", "ignore") for p in _kept(raw, spans)[0])


def _in_bytes(text: bytes, spans) -> list[dict[str, int]]:
    """Spans of words as spans of bytes, from the first word's first byte to the last word's last."""
    starts, ends = _word_bounds(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    return [{"from": int(starts[s["from"]]), "to": int(ends[s["to"] - 1])} for s in spans]


def drop_repeats(docs: DataFrame, depth: int = DEPTH, words: int | None = None) -> DataFrame:
    """The documents without their repeated bytes, with all their columns.

    With ``words``, passages of that many words that start at two places go too, from their first word to their last;
    what stands between words there may differ. A character that is cut goes as a whole. A document that loses every
    word is dropped; one that loses nothing stays as it is. Other columns keep their values.
    """
    whole = docs.select("doc_id", "text", F.struct("*").alias("_doc"))
    spans = _all_spans(docs, depth, words).select(F.col("row").alias("_row"), "spans", "words")
    marked = whole.select("_doc", F.xxhash64("doc_id", "text").alias("_key")).join(spans, F.col("_key") == F.col("_row"), "left")

    def cut(texts: pa.Array, spans: pa.Array, words: pa.Array) -> pa.Array:
        out = []
        for text, s, w in zip(texts.to_pylist(), spans.to_pylist(), words.to_pylist()):
            if text is None or not s and not w:
                out.append(text)
                continue
            raw = text.encode()
            out.append(_text_of(raw, (s or []) + (_in_bytes(raw, w) if w else [])))
        return pa.array(out, pa.string())

    left = F.arrow_udf(cut, "string")(F.col("_doc.text"), F.col("spans"), F.col("words"))
    cleaned = marked.withColumn("_left", F.when(F.col("_row").isNull(), F.col("_doc.text")).otherwise(left))
    stays = cleaned.filter(F.col("_row").isNull() | F.col("_left").rlike(NON_SPACE))
    return stays.select(F.col("_doc").withField("text", F.col("_left")).alias("_doc")).select("_doc.*")
