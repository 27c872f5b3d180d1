"""Sentence-piece encoding and decoding on the tokenizers library.

The model file (a protobuf) is parsed here; its normaliser, white-space marker, pieces
with scores (unigram scores or BPE ranks) and byte fallback are rebuilt as a tokenizers
pipeline. Where no piece crosses a blank, a text's ids are the ids of its
blank-separated units one after another, so each distinct unit of a batch is encoded once.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfspark.llm.hashing import tidy
from shelfspark.llm.wordids import _Ids, slices

MARK = "▁"
# Piece types and model types of the file format.
NORMAL, UNK, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2

_codecs: dict[tuple[str, int], PieceCodec] = {}


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) pairs of one protobuf message; 4- and 8-byte values come as bytes."""
    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            b = data[at]
            value |= (b & 0x7F) << shift
            at, shift = at + 1, shift + 7
            if b < 0x80:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = (8, at) if kind == 1 else (4, at) if kind == 5 else varint(at)
            value, at = data[at:at + size], at + size
        yield key >> 3, value


def read_model(path: str) -> dict:
    """Pieces (text, score, type), model type, byte fallback, unknown id and normaliser settings of a model file."""
    with open(path, "rb") as f:
        data = f.read()
    model = {"pieces": [], "type": UNIGRAM, "byte_fallback": False, "unk_id": 0, "charsmap": b"", "prefix": True, "squeeze": True}
    for number, value in _fields(data):
        if number == 1:
            piece = {1: b"", 2: struct.pack("<f", 0.0), 3: NORMAL} | dict(_fields(value))
            model["pieces"].append((piece[1].decode(), struct.unpack("<f", piece[2])[0], piece[3]))
        elif number == 2:
            spec = dict(_fields(value))
            model |= {"type": spec.get(3, UNIGRAM), "byte_fallback": bool(spec.get(35, 0)), "unk_id": spec.get(40, 0)}
        elif number == 3:
            spec = dict(_fields(value))
            model |= {"charsmap": spec.get(2, b""), "prefix": bool(spec.get(3, 1)), "squeeze": bool(spec.get(4, 1))}
    return model


def _merges(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """Every split of a piece into two pieces, the best-scored piece first."""
    scores = {p: s for p, s, kind in pieces if kind in (NORMAL, USER)}
    found = [(-s, len(p), i, p) for p, s in scores.items() for i in range(1, len(p)) if p[:i] in scores and p[i:] in scores]
    return [(p[:i], p[i:]) for _, _, i, p in sorted(found, key=lambda x: (x[0], x[2]))]


class PieceCodec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str, threads: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

        model = read_model(path)
        pieces = model["pieces"]
        if model["type"] == UNIGRAM:
            built = models.Unigram([(p, s) for p, s, _ in pieces], unk_id=model["unk_id"], byte_fallback=model["byte_fallback"])
        elif model["type"] == BPE:
            built = models.BPE(vocab={p: i for i, (p, _, _) in enumerate(pieces)}, merges=_merges(pieces), unk_token=pieces[model["unk_id"]][0],
                               fuse_unk=True, byte_fallback=model["byte_fallback"])
        else:
            raise ValueError(f"model type {model['type']} is neither unigram nor BPE")
        steps = [normalizers.Precompiled(model["charsmap"])] if model["charsmap"] else []
        if model["squeeze"]:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if model["prefix"]:
            steps.append(normalizers.Prepend(MARK))
        self.tokenizer = Tokenizer(built)
        self.tokenizer.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
        self.tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(),
                                                    *([decoders.Strip(" ", 1, 0)] if model["prefix"] else [])])
        self.tokenizer.add_tokens([AddedToken(p, normalized=False) for p, _, kind in pieces if kind == USER])
        # Units are independent if no piece has the marker after another character, and the text is not rewritten.
        crossing = any(MARK in p.lstrip(MARK) for p, _, kind in pieces if kind in (NORMAL, USER))
        self.by_unit = model["prefix"] and not model["squeeze"] and not model["charsmap"] and not crossing
        self.units = _Ids()
        self.path, self._other = path, None
        self.differing: set[str] = set()

    def _encode_units(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words = new.to_pylist()
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        self.differing.update(w for w, a, b in zip(words, ids, self.reference(words)) if a != b)
        self.differing.update(w for w, back in zip(words, self.tokenizer.decode_batch(ids, skip_special_tokens=False)) if back != w)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((x for i in ids for x in i), np.int32, int(lengths.sum())), lengths

    def reference(self, texts: list[str]) -> list[list[int]]:
        """Ids by the sentencepiece library, for the parity check."""
        if self._other is None:
            import sentencepiece

            self._other = sentencepiece.SentencePieceProcessor(model_file=self.path)
        return self._other.encode(texts, num_threads=1) if texts else []

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, where each text's ids start, and whether ids equal the reference library's and decode to the text.

        A text with blanks at its ends or in a row is encoded as a whole, since runs of blanks have pieces of their own.
        """
        texts = texts.fill_null("")
        whole = pc.or_(pc.match_substring_regex(texts, "^ | $|  "), pc.equal(texts, "")) if self.by_unit else pa.array([True] * len(texts))
        whole = whole.to_numpy(zero_copy_only=False)
        split = pc.split_pattern(pc.if_else(pa.array(whole), pa.scalar(""), texts), " ")
        offsets = split.offsets.to_numpy().astype(np.int64)
        coded = split.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        rows = self.units.rows(coded.dictionary, self._encode_units)[coded.indices.to_numpy()]
        ids, lengths = self.units.gather(rows)
        starts = np.concatenate([[0], np.cumsum(lengths)])[offsets - offsets[0]]
        same = np.ones(len(texts), bool)
        if self.differing:
            bad = pc.is_in(coded.dictionary, value_set=pa.array(sorted(self.differing), pa.string())).to_numpy(zero_copy_only=False)
            upto = np.concatenate([[0], np.cumsum(bad[coded.indices.to_numpy()])])[offsets - offsets[0]]
            same = np.diff(upto) == 0
        at = np.flatnonzero(whole)
        if len(at):
            some = texts.take(pa.array(at)).to_pylist()
            own = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            back = self.tokenizer.decode_batch(own, skip_special_tokens=False)
            same[at] = [a == b and t == r for a, b, t, r in zip(own, self.reference(some), some, back)]
            parts = np.split(ids, starts[1:-1])
            for i, x in zip(at, own):
                parts[i] = np.asarray(x, np.int32)
            ids = np.concatenate(parts) if parts else ids
            starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return ids, starts, same

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def codec(path: str, threads: int = 2) -> PieceCodec:
    """The worker's codec of a model file."""
    if (path, threads) not in _codecs:
        _codecs[path, threads] = PieceCodec(path, threads)
    return _codecs[path, threads]


def encode_documents(docs: DataFrame, model: str | None = None, threads: int = 2) -> DataFrame:
    """doc_id and the ids (array of int) of every row's whole text; null text has none."""
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                ids, starts, _ = codec(path, threads).encode(part["text"])
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids))], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(tidy(run), docs.select("doc_id").schema.add("ids", T.ArrayType(T.IntegerType())))


def decode_documents(coded: DataFrame, model: str | None = None, threads: int = 2) -> DataFrame:
    """doc_id and text of rows (doc_id, ids); null ids give an empty text."""
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = codec(path, threads).decode([x or [] for x in batch["ids"].to_pylist()])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(tidy(run), coded.select("doc_id").schema.add("text", "string"))


def encoding_report(docs: DataFrame, model: str | None = None, threads: int = 2) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (little-endian unsigned 32-bit ids) and parity of every row.

    parity: the ids equal those of the sentencepiece library and decode to the text; it is checked
    on every distinct unit and on every text that is encoded as a whole. Null and empty texts have no ids.
    Repeated rows give repeated results; other columns are left out; an empty table gives an empty result.
    """
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                ids, starts, same = codec(path, threads).encode(part["text"])
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(np.diff(starts), pa.int64()), pa.array(crc, pa.int64()), pa.array(same)],
                    ["doc_id", "n_tokens", "ids_crc32", "parity"])

    schema = docs.select("doc_id").schema.add("n_tokens", "long").add("ids_crc32", "long").add("parity", "boolean")
    return docs.select("doc_id", "text").mapInArrow(tidy(run), schema)
