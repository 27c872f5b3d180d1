"""Fingerprints, shards and quality rules against plain Python over the given and edge-case documents."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

from shelfspark.llm import fingerprints, quality, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MASK = (1 << 64) - 1


def rows_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.collect()]


def hash_longs(values):
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest((v & MASK).to_bytes(8, "little"), h)
    return h


def brute_sketch(text, k=fingerprints.K):
    w = WORD.findall(text.lower())
    one = lambda s: xxhash.xxh64_intdigest(s.encode(), 42)
    if not w:
        return []
    if len(w) < 5:
        hashes = {one(" ".join(w))}
    else:
        hs = [one(x) for x in w]
        hashes = {hash_longs(hs[i:i + 5]) for i in range(len(w) - 4)}
    return sorted({h >> 12 for h in hashes})[:k]


def near(a, b, k=fingerprints.K):
    u = sorted(set(a) | set(b))[:k]
    return 1.0 if not u else len(set(u) & set(a) & set(b)) / len(u)


def check_fingerprints(df):
    tie = lambda text: (xxhash.xxh64_intdigest(text.encode(), 42) + (1 << 63)) % (1 << 64)  # noqa: E731  (order of the signed hash)
    docs = sorted(rows_of(df), key=lambda d: (d[0] is not None, d[0] or 0, tie(d[1])))
    got = defaultdict(list)
    for r in fingerprints.edited_fingerprints(df).collect():
        got[r["doc_id"]].append(r)
    assert sum(map(len, got.values())) == len(docs)
    for i, (doc, text) in enumerate(docs):
        nxt = docs[(i + 1) % len(docs)][1]
        q = len(text) // 4
        edited = text[:len(text) - q] + nxt[:q]
        s, e = brute_sketch(text), brute_sketch(edited)
        match = [r for r in got[doc] if r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()]
        assert match, doc
        r = match[0]
        got[doc].remove(r)
        assert r["n_chars"] == len(text)
        assert r["fingerprint"] == "".join(f"{h:013x}" for h in s)
        assert r["edited_fingerprint"] == "".join(f"{h:013x}" for h in e)
        assert math.isclose(r["near_edited"], near(s, e)) and math.isclose(r["near_next"], near(s, brute_sketch(nxt)))


def test_fingerprints(small_docs):
    check_fingerprints(small_docs)


def test_fingerprint_edges(edge_docs, no_docs):
    check_fingerprints(edge_docs)
    assert fingerprints.edited_fingerprints(no_docs).count() == 0
    check_fingerprints(edge_docs.filter("doc_id = 0"))


def test_fingerprints_of_a_hot_id_and_a_hot_row(spark, monkeypatch):
    # A third of the rows has no id and many texts, a third is one row over and over.
    monkeypatch.setattr(fingerprints, "BUCKET_BYTES", 256)
    monkeypatch.setattr(fingerprints, "SAME_ROWS", 20)
    monkeypatch.setattr(fingerprints, "COPIES_PER_CHUNK", 7)
    text = lambda i: " ".join(f"w{i * j % 11}" for j in range(1, 4 + i % 9))
    rows = [(None, text(i)) for i in range(60)] + [(7, "one row over and over again")] * 60 + [(i, text(i)) for i in range(60)]
    check_fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))
    check_fingerprints(spark.createDataFrame([(None, None)] * 50, "doc_id bigint, text string"))


def test_sketches_merge_and_estimate(spark, small_docs):
    from pyspark.sql import functions as F

    parts = small_docs.select(F.col("lang").alias("k"), fingerprints.sketch(F.col("text")).alias("sketch"))
    got = {r["k"]: r["sketch"] for r in fingerprints.merge_sketches(parts, "k").collect()}
    whole = defaultdict(set)
    for r in small_docs.select("lang", "text").collect():
        whole[r["lang"]] |= set(brute_sketch(r["text"], 10 ** 9))
    assert got == {k: sorted(v)[:fingerprints.K] for k, v in whole.items()}
    big = max(whole, key=lambda k: len(whole[k]))
    one = spark.createDataFrame([(got[big],)], "s array<bigint>")
    estimate = one.select(fingerprints.distinct_shingles(F.col("s")).alias("d")).first()["d"]
    assert abs(estimate / len(whole[big]) - 1) < 0.35


def test_containment(spark):
    from pyspark.sql import functions as F

    inner = " ".join(f"w{i}" for i in range(400))
    df = spark.createDataFrame([(inner, inner + " " + " ".join(f"v{i}" for i in range(400)))], "a string, b string")
    s = df.select(fingerprints.sketch(F.col("a")).alias("a"), fingerprints.sketch(F.col("b")).alias("b"))
    r = s.select(fingerprints.containment(F.col("a"), F.col("b")).alias("ab"), fingerprints.containment(F.col("b"), F.col("a")).alias("ba")).first()
    assert r["ab"] > 0.85 and 0.35 < r["ba"] < 0.65


def check_shards(df):
    docs = rows_of(df)
    got = sharding.shard_documents(df).collect()
    want = []
    for doc, text in docs:
        def best(n):
            key = "" if doc is None else str(doc)
            u = [(int(hashlib.md5(f"{key}:{s}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52 for s in range(n)]
            return min(range(n), key=lambda s: (-math.log(u[s]), s))
        want.append((doc, len(text.encode()) + 1, zlib.crc32(text.encode()), "key", best(8), best(9)))
    assert Counter(want) == Counter((r["doc_id"], r["size"], r["text_crc32"], r["law"], r["shard"], r["grown_shard"]) for r in got)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 8)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards(small_docs, edge_docs, no_docs, monkeypatch):
    check_shards(small_docs)
    monkeypatch.setattr(sharding, "ROWS_PER_CELL", 7)
    check_shards(small_docs)
    check_shards(edge_docs)
    assert sharding.shard_documents(no_docs).count() == 0


def test_weighted_shards_follow_weights(spark):
    df = sharding.assign(spark.range(20_000), "id", {0: 1.0, 1: 3.0})
    share = df.filter("shard = 1").count() / 20_000
    assert 0.73 < share < 0.77


def brute_quality(text):
    w = WORD.findall(text)
    at = defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i:i + 8])].append(i)
    hit = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), failed)


def check_quality(df):
    got = quality.quality_documents(df).collect()
    want = Counter((d, *brute_quality(t)) for d, t in rows_of(df))
    assert want == Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                            r["base_failed"]) for r in got)
    assert all(r["kept"] == (not r["base_failed"] and not r["host_rejected"]) for r in got)
    kept = Counter(r["doc_id"] for r in got if r["kept"])
    assert kept == Counter(r["doc_id"] for r in quality.keep_good(df).collect())


def test_quality(small_docs, edge_docs, no_docs):
    check_quality(small_docs)
    check_quality(edge_docs)
    assert quality.quality_documents(no_docs).count() == 0
    assert quality.keep_good(edge_docs).columns == edge_docs.columns


def test_bad_host_is_rejected(spark):
    good = " ".join(f"w{i}" for i in range(40))
    rows = [(i, good, "clean") for i in range(60)] + [(100 + i, "too short", "junk") for i in range(50)] + [(200 + i, good, "junk") for i in range(5)]
    rows += [(300 + i, "short", "tiny") for i in range(1)] + [(400, good, "tiny")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = {r["doc_id"] for r in quality.quality_documents(docs).filter("kept").collect()}
    assert kept == set(range(60)) | {400}


def test_slots_of_a_hot_key(spark, monkeypatch):
    """A third of all rows share a null id and a text: no cell holds far more rows than it should, and slots stay gapless."""
    monkeypatch.setattr(sharding, "ROWS_PER_CELL", 200)
    rows = [(None, "same") for _ in range(3000)] + [(i, f"text {i}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    narrow = docs.select("doc_id", sharding.shard_of(docs.doc_id, {s: 1.0 for s in range(8)}).alias("shard"))
    sizes = [r["count"] for r in sharding.dealt(narrow, "shard", "doc_id").groupBy("shard", "_cell", "_sub").count().collect()]
    assert max(sizes) < 450 and sum(sizes) == 9000
    got = sharding.shard_documents(docs).collect()
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r["shard"]].append(r["slot"])
    assert len(got) == 9000 and all(sorted(v) == list(range(len(v))) for v in by_shard.values())
