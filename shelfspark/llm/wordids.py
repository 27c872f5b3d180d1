"""Token ids of whole texts by a public tokenizer, word by word.

For a tokenizer that drops white space before it cuts words, the ids of a text are
the ids of its white-space separated words one after another. A batch's
distinct words are encoded once, and a bounded table of known words stays
with the Python worker. All state is per task; Spark partitions the texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BATCH_BYTES = 4 << 20
MOST_KNOWN = 500_000
# A run of Latin letters: its normal form and lower case are one letter each, and it is one word to the pre-tokenizer.
LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-įı-ɏ]+")
# Such a run with one mark after it, which is always a word of its own.
LETTERS_AND_MARK = r"^[a-zß-öø-ÿ]+[.,;:!?|]$"

_encoders: dict[str, WordEncoder] = {}


def _byte_letters() -> list[str]:
    """Letter that stands for each byte in byte-level vocabularies: printable Latin-1 as it is, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(other)) for b in range(256)]


class _Ids:
    """Known strings and their ids, one flat array."""

    def __init__(self):
        self.known = pa.array([], pa.string())
        self.ids = np.zeros(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    def add(self, new: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.known = pa.concat_arrays([self.known, new])
        self.ids = np.concatenate([self.ids, ids])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the rows one after another, and the length of each."""
        lengths = np.diff(self.starts)[rows]
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[:-1][rows] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
        return self.ids[at], lengths

    def rows(self, distinct: pa.Array, make) -> np.ndarray:
        """Row of each of the distinct strings; ``make`` gives ids and lengths of those not yet known."""
        if len(self.known) > MOST_KNOWN:
            self.__init__()
        at = pc.index_in(distinct, value_set=self.known)
        missing = at.is_null()
        rows = at.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        new = distinct.filter(missing)
        if len(new):
            rows[missing.to_numpy(zero_copy_only=False)] = np.arange(len(self.known), len(self.known) + len(new))
            self.add(new, *make(new))
        return rows


class WordEncoder:
    """Ids of texts under a tokenizers-library file whose pre-tokenizer drops white space."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.words, self.cores = _Ids(), _Ids()

    def _encode_cores(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words, letters, model = new.to_pylist(), self.letters, self.tokenizer.model
        out, rest = [None] * len(words), []
        for i, w in enumerate(words):
            if not LETTERS.fullmatch(w):
                rest.append(i)
                continue
            w = w.lower()
            out[i] = [t.id for t in model.tokenize(w if w.isascii() else "".join([letters[b] for b in w.encode()]))]
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([words[i] for i in rest], add_special_tokens=False)):
            out[i] = e.ids
        lengths = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter((x for ids in out for x in ids), np.int32, int(lengths.sum())), lengths

    def _encode_words(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Words are lower-cased (unless they may hold a special token's string) and cut before a last mark."""
        low = pc.if_else(pc.match_substring(new, "<|"), new, pc.ascii_lower(new))
        marked = pc.match_substring_regex(low, LETTERS_AND_MARK)
        core = pc.if_else(marked, pc.utf8_slice_codeunits(low, 0, -1), low)
        mark = pc.if_else(marked, pc.utf8_slice_codeunits(low, -1), "")
        coded = pa.concat_arrays([core, mark]).dictionary_encode()
        rows = self.cores.rows(coded.dictionary, self._encode_cores)[coded.indices.to_numpy()]
        ids, lengths = self.cores.gather(rows.reshape(2, -1).T.ravel())
        return ids, lengths.reshape(-1, 2).sum(axis=1)

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Word rows in the known table, and where each text's words start."""
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        offsets = split.offsets.to_numpy().astype(np.int64)
        flat = split.values.slice(offsets[0], offsets[-1] - offsets[0])
        coded = flat.dictionary_encode()
        rows = self.words.rows(coded.dictionary, self._encode_words)[coded.indices.to_numpy()]
        return rows, offsets - offsets[0]

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        rows, offsets = self._words(texts)
        total = np.concatenate([[0], np.cumsum(np.diff(self.words.starts)[rows])])
        return total[offsets[1:]] - total[offsets[:-1]]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's ids start (one more than texts)."""
        rows, offsets = self._words(texts)
        ids, lengths = self.words.gather(rows)
        return ids, np.concatenate([[0], np.cumsum(lengths)])[offsets]


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def slices(batch: pa.RecordBatch, column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes of the text column (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // most
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)
