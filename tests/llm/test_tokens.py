"""Token counts, packing and sentence-piece coding against direct use of the tokenizer libraries."""

import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from shelfspark.llm import packing, piece_codec, token_counts

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
ODD = ["<|endoftext|>x <|STARTOFTEXT|> <|", "don't DON'T 'S x's|y a.b", "É́ é İ ß ﬁ ǅ Ŀ ŉ", " a b\u0085c\x1cd", "...., a.. b!? 12a a1 x|", "🙂 東京は"]


@pytest.fixture(scope="module")
def odd_docs(spark):
    return spark.createDataFrame([(100 + i, t) for i, t in enumerate(ODD)], "doc_id bigint, text string")


def ids_of(docs):
    t = Tokenizer.from_file(WORD_BPE)
    rows = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    return [(d, e.ids) for (d, _), e in zip(rows, t.encode_batch([x for _, x in rows], add_special_tokens=False))]


def check_packing(docs, capacity=2048):
    got = packing.pack_documents(docs, capacity).collect()
    want = []
    for d, ids in ids_of(docs):
        ids = [*ids, 0]
        for p, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a:a + capacity]
            want.append((d, p, a, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    assert Counter(want) == Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got)
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(bins), -(-sum(w[3] for w in want) // capacity)


def test_packing(small_docs, edge_docs, odd_docs, no_docs):
    used, least = check_packing(small_docs)
    assert used <= least * 1.02 + 1
    check_packing(edge_docs)
    check_packing(odd_docs)
    used, least = check_packing(small_docs, 300)
    assert used <= least * 1.05 + 1
    assert packing.pack_documents(no_docs).count() == 0


def test_packing_of_equal_sizes(spark):
    pieces = spark.range(1000).selectExpr("id", "cast(case when id % 3 = 0 then 700 else 600 end as bigint) as size")
    got = packing.best_fit(pieces, 2048)
    assert got.count() == 1000 and got.select("id").distinct().count() == 1000
    assert got.select("bin").distinct().count() <= 340
    tiny = packing.best_fit(spark.range(5000).selectExpr("id", "1L as size"), 2048)
    assert tiny.select("bin").distinct().count() == 3
    full = packing.best_fit(spark.range(50).selectExpr("id", "2048L as size"), 2048)
    assert full.select("bin").distinct().count() == 50


def test_packed_sequences_round_trip(small_docs):
    docs = small_docs.limit(40)
    seqs = packing.packed_sequences(docs).collect()
    assert all(len(r["ids"]) <= 2048 for r in seqs)
    assert Counter(i for r in seqs for i in r["ids"]) == Counter(i for _, ids in ids_of(docs) for i in [*ids, 0])


def test_token_counts(small_docs, edge_docs, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK", 100)
    for docs in (small_docs, edge_docs, odd_docs):
        lengths = [len(ids) for _, ids in ids_of(docs)]
        want = [(n, c, sum(x > n for x in lengths), sum(lengths), sum(min(x, n) for x in lengths), sum(max(0, x - n) for x in lengths),
                 sum(x <= n for x in lengths) / len(lengths)) for n, c in sorted(Counter(lengths).items())]
        got = sorted(map(tuple, token_counts.token_counts(docs).collect()))
        assert [g[:6] for g in got] == [w[:6] for w in want]
        assert all(abs(g[6] - w[6]) < 1e-12 for g, w in zip(got, want))
    sums = token_counts.suffix_sums(token_counts.length_histogram(token_counts.document_lengths(small_docs)))
    lengths = sorted(len(ids) for _, ids in ids_of(small_docs))
    for limit in (1, 77, 1024, 10 ** 6):
        assert token_counts.truncated_total(sums, limit) == sum(min(x, limit) for x in lengths)
    for share in (0.1, 0.5, 0.99, 1.0):
        want = next(x for x in lengths if sum(y <= x for y in lengths) >= share * len(lengths) - 1e-9)
        assert token_counts.length_quantile(sums, share) == want
    assert token_counts.token_counts(no_docs).count() == 0


PIECES = ["a  b", " x", "x ", "", "a\n b", "東京 は🙂", "<s> </s> <unk> <0x41>", None, "    code\tx", "end."]


def test_sentence_pieces(spark, small_docs, edge_docs, no_docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=piece_codec.default_model())
    odd = spark.createDataFrame(list(enumerate(PIECES)), "doc_id bigint, text string")
    for docs in (small_docs, edge_docs, odd):
        rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
        ids = sp.encode([t for _, t in rows])
        want = Counter((d, len(i), zlib.crc32(struct.pack(f"<{len(i)}I", *i)), True) for (d, _), i in zip(rows, ids))
        assert Counter(map(tuple, piece_codec.encoding_report(docs).collect())) == want
        coded = piece_codec.encode_documents(docs)
        back = Counter((r["doc_id"], r["text"]) for r in piece_codec.decode_documents(coded).collect())
        assert back == Counter(rows)
    assert piece_codec.encoding_report(no_docs).count() == 0


def test_literal_marker_is_reported(spark):
    docs = spark.createDataFrame([(1, "a ▁ b")], "doc_id bigint, text string")
    assert [r["parity"] for r in piece_codec.encoding_report(docs).collect()] == [False]


def test_unigram_models_are_rebuilt(tmp_path, monkeypatch):
    """A small hand-written unigram model: the best segmentation by scores, and byte fallback."""
    def field(n, kind, body):
        return bytes([(n << 3) | kind]) + (bytes([len(body)]) + body if kind == 2 else body)

    def varint(n, value):
        key, out = (n << 3), b""
        while key >= 0x80:
            out, key = out + bytes([key & 0x7F | 0x80]), key >> 7
        return out + bytes([key, value])

    pieces = [("<unk>", 0.0, 2)] + [(f"<0x{b:02X}>", -9.0, 6) for b in range(256)]
    pieces += [("▁", -3.0, 1), ("▁ab", -1.0, 1), ("a", -2.0, 1), ("b", -2.0, 1), ("bb", -2.5, 1)]
    data = b"".join(field(1, 2, field(1, 2, p.encode()) + field(2, 5, struct.pack("<f", s)) + varint(3, k)) for p, s, k in pieces)
    spec = varint(3, 1) + varint(35, 1)
    data += field(2, 2, spec) + field(3, 2, varint(3, 1) + varint(4, 0))
    path = tmp_path / "small.model"
    path.write_bytes(data)
    codec = piece_codec.PieceCodec(str(path), 1)
    monkeypatch.setattr(codec, "reference", lambda texts: [codec.tokenizer.encode(t).ids for t in texts])
    ids, starts, _ = codec.encode(pa.array(["abbb ab", "é"]))
    names = [p for p, _, _ in pieces]
    assert [names[i] for i in ids[:starts[1]]] == ["▁ab", "bb", "▁ab"]
    assert [names[i] for i in ids[starts[1]:]] == ["▁", "<0xC3>", "<0xA9>"]
    assert codec.decode([ids[:starts[1]].tolist(), ids[starts[1]:].tolist()]) == ["abbb ab", "é"]
