"""N-gram Jaccard classes and repeated windows against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from shelfspark.llm import hashing, jaccard, linking, repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string"


def shingles(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_classes(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[top(i)].append(rows[i][0])
    low = {k: min([x for x in v if x is not None], default=None) for k, v in members.items()}
    return Counter((d, len(s), low[top(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def check_classes(df):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert Counter(map(tuple, jaccard.jaccard_classes(df).collect())) == brute_classes(rows)


def planted(n_groups=12, copies=14, seed=5):
    """Near-copy groups with chained links, a passage that many texts share, short texts and copies."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    passage = [word() for _ in range(60)]
    texts = []
    for g in range(n_groups):
        base = [word() for _ in range(rng.randint(20, 120))]
        for _ in range(copies):
            t = list(base)
            for _ in range(rng.randint(0, 4)):
                t[rng.randrange(len(t))] = word()
            texts.append(" ".join(t))
    texts += [" ".join([word() for _ in range(rng.randint(5, 60))] + passage) for _ in range(60)]
    texts += [" ".join(word() for _ in range(n)) for n in (1, 2, 3, 4, 5)] + ["Ab CD ef", "aB cd EF", "ab\tcd\nef"]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_hashed_shingles_match_words():
    texts = ["a b c d e f", "A\tb  c\n d e f ", " a b", "", None, "x", "é É b c d e"]
    got = hashing.shingle_hashes(pa.array(texts), 5)
    assert [len(g) for g in got] == [len(shingles(t)) for t in texts]
    assert (got[0] == got[1]).all() and not (got[2] == got[5]).any()


def test_classes(spark, small_docs, edge_docs, no_docs):
    check_classes(small_docs)
    check_classes(edge_docs)
    check_classes(spark.createDataFrame(planted(), DOCS))
    assert jaccard.jaccard_classes(no_docs).count() == 0


@pytest.mark.parametrize("rounds,per_member", [(1, 2), (6, 0)])
def test_classes_by_hub_rounds(spark, monkeypatch, rounds, per_member):
    """The same classes whether the rest of the pairs is tested early or only after many hub rounds."""
    monkeypatch.setattr(linking, "MOST_HUB_ROUNDS", rounds)
    monkeypatch.setattr(linking, "PAIRS_PER_MEMBER", per_member)
    check_classes(spark.createDataFrame(planted(4, 10, 9), DOCS))


def test_hubs_of_a_large_key(spark):
    """Two chains of 200 members under the same three keys: facts and hubs leave few of the 79,800 pairs to be tested."""
    from pyspark.sql import functions as F

    rows = [(k, n, 1, 0, True) for k in range(3) for n in range(400)]
    members = spark.createDataFrame(rows, "key long, node long, size long, place long, hub boolean")
    facts = spark.range(400).select(F.col("id").alias("node"), F.col("id").alias("x"))
    tested = []

    def test(pairs):
        tested.append(pairs.count())
        return pairs.filter("b - a <= 20 and (a < 200) = (b < 200)")

    near = lambda a, b: F.abs(a("x") - b("x")) <= 25
    got = {r["node"]: r["label"] for r in linking.link_members(members, test, facts=facts, facts_fit=near).collect()}
    assert got == {n: 0 if n < 200 else 200 for n in range(400)}
    assert sum(tested) < 5_000, tested


def test_slow_rounds_end(spark):
    """A key of 320 members in groups of four: each round of hubs would merge too few classes, so all pairs follow at once;
    the facts are joined once a round, to a table that is written."""
    from pyspark.sql import functions as F

    members = spark.createDataFrame([(1, n, 10, 0, True) for n in range(320)], "key long, node long, size long, place long, hub boolean")
    facts = spark.createDataFrame([(n, n // 4) for n in range(320)], "node long, x long")
    tested, was = [], linking._open
    written = []

    def opened(*args):
        got = was(*args)
        written.append(got[0].columns)
        return got

    def test(pairs):
        tested.append(pairs.count())
        return pairs.filter("floor(a / 4) = floor(b / 4)")

    linking._open = opened
    try:
        near = lambda a, b: a("x") == b("x")
        got = {r["node"]: r["label"] for r in linking.link_members(members, test, facts=facts, facts_fit=near).collect()}
    finally:
        linking._open = was
    assert got == {n: n // 4 * 4 for n in range(320)}
    assert len(tested) <= 3, tested
    assert all("x" in c for c in written) and written


@pytest.mark.parametrize("most", [3, 50_000])
def test_rounds_link_classes(spark, monkeypatch, most):
    """Each round links the classes that its own links join, once each: no round goes over the links before it, or over all links between two classes."""
    rng = random.Random(6)
    rows = [(k, n, 10, 0, True) for k in range(6) for n in rng.sample(range(120), 50)]
    members = spark.createDataFrame(rows, "key long, node long, size long, place long, hub boolean")
    shared = {(a, b) for k in range(6) for x in [[r[1] for r in rows if r[0] == k]] for a in x for b in x if a < b and abs(a - b) <= 30 and a // 60 == b // 60}
    monkeypatch.setattr(linking, "EDGES_PER_PARTITION", most)
    monkeypatch.setattr(linking, "PAIRS_PER_MEMBER", 0)
    monkeypatch.setattr(linking, "ENOUGH_PROGRESS", 2)
    monkeypatch.setattr(linking, "MOST_HUB_ROUNDS", 3)
    was, edges, found = linking.components, [], []

    def components(df):
        edges.append([tuple(r) for r in df.collect()])
        return was(df)

    def test(pairs):
        got = pairs.filter("b - a <= 30 and floor(a / 60) = floor(b / 60)")
        found.append(got.count())
        return got

    monkeypatch.setattr(linking, "components", components)
    got = {r["node"]: r["label"] for r in linking.link_members(members, test).collect()}
    want = {n: n for pair in shared for n in pair}
    for _ in range(120):
        for a, b in shared:
            want[a] = want[b] = min(want[a], want[b])
    assert got == want
    assert len(edges) >= 3 and len(edges[0]) == found[0]
    for x, n in zip(edges[1:], [n for n in found[1:] if n]):
        assert len(x) == len(set(x)) <= n, (len(x), n)


def test_keep_one(edge_docs, small_docs):
    for df in (edge_docs, small_docs):
        rows = [(r["doc_id"], r["text"]) for r in df.collect()]
        got = Counter((r["doc_id"], r["text"]) for r in jaccard.keep_one(df).collect())
        want = {d for (d, n, c) in brute_classes(rows) if d == c}
        assert {d for d, _ in got} == want and not got - Counter(rows)
        assert all(n == 1 for (d, t), n in got.items() if shingles(t))
    assert jaccard.keep_one(edge_docs).columns == edge_docs.columns


def test_keep_one_per_group(spark):
    """Rows that share an id, or have none, go only if their texts link to a row that stays."""
    rng = random.Random(8)
    text = lambda: [f"w{rng.randrange(10 ** 6)}" for _ in range(40)]
    near = lambda t: " ".join(t[:-1] + ["other"])
    a, b, c, d, e, f, g, h = (text() for _ in range(8))
    whole = lambda t: " ".join(t)
    alone = [(None, whole(a)), (None, whole(b)), (None, whole(c)), (5, whole(d)), (5, whole(e)), (9, whole(f)), (None, None), (None, "")]
    groups = [[(None, whole(g)), (None, near(g)), (None, whole(g))], [(None, whole(h)), (7, near(h)), (8, whole(h))], [(9, near(b))], [(6, near(e))]]
    rows = alone + [r for x in groups for r in x]
    got = Counter(map(tuple, jaccard.keep_one(spark.createDataFrame(rows, DOCS)).collect()))
    of_g = [x for x in got if x in groups[0]]
    assert len(of_g) == 1 and got[of_g[0]] == 1
    want = [r for r in alone if r != (None, whole(b))] + [(7, near(h)), (9, near(b))]
    assert got - Counter(of_g) == Counter(want)


def test_filters_hold_every_key(spark):
    from pyspark.sql import functions as F

    keys = spark.range(5000).select(F.xxhash64("id").alias("k")).unionByName(spark.sql("select k from values (0L), (-1L), (1L << 40) t(k)"))
    values = np.array([r["k"] for r in keys.collect()], np.int64)
    bits = hashing.bit_filter(keys, F.col("k"), 20)
    assert hashing.passes(bits, values).all()
    other = np.arange(10_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert hashing.passes(bits, other).mean() < 0.02


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    got = {r["node"]: r["label"] for r in linking.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    label = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in range(400):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert got == label


@pytest.mark.parametrize("most", [10, 50_000])
def test_few_edges_stay_in_one_partition(spark, monkeypatch, most):
    """A step over few edges is one task, however many partitions a shuffle has; many edges are dealt, with the same classes."""
    monkeypatch.setattr(linking, "EDGES_PER_PARTITION", most)
    edges = spark.createDataFrame([(c * 100 + i, c * 100 + i + 1) for c in range(5) for i in range(40)], "a bigint, b bigint").coalesce(1)
    key, sc = "spark.sql.adaptive.coalescePartitions.enabled", spark.sparkContext
    before, group = spark.conf.get(key), f"components-{most}"
    spark.conf.set(key, "false")
    sc.setJobGroup(group, group)
    try:
        got = {r["node"]: r["label"] for r in linking.components(edges).collect()}
    finally:
        spark.conf.set(key, before)
        sc.setJobGroup("", "")
    assert got == {c * 100 + i: c * 100 for c in range(5) for i in range(41)}
    tracker = sc.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
    tasks = sum(s.numCompletedTasks for j in jobs for s in map(tracker.getStageInfo, j.stageIds) if s)
    assert tasks / len(jobs) <= 2 if most > 200 else tasks / len(jobs) > 5, (tasks, len(jobs))


def runs_of(covered):
    return sum(1 for i, c in enumerate(covered) if c and not (i and covered[i - 1]))


def brute_repeats(rows, depth, n=51):
    count = Counter(b[i:i + depth] for b in (x.encode() for _, t in rows for x in [t or ""]) for i in range(len(b) - depth + 1))
    spans = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())] for _, t in rows]
    passages = [[tuple((t or "").encode()[a:b] for a, b in s[i:i + n]) for i in range(len(s) - n + 1)] for (_, t), s in zip(rows, spans)]
    of_words = Counter(w for ws in passages for w in ws)
    out = Counter()
    for (d, text), places, windows in zip(rows, spans, passages):
        b = (text or "").encode()
        covered, more = bytearray(len(b)), bytearray(len(b))
        for i in range(len(b) - depth + 1):
            if count[b[i:i + depth]] > 1:
                covered[i:i + depth] = b"\1" * depth
        for i, w in enumerate(windows):
            if of_words[w] > 1:
                more[places[i][0]:places[i + n - 1][1]] = b"\1" * (places[i + n - 1][1] - places[i][0])
        kept = bytes(x for x, c in zip(b, covered) if not c)
        left, at = [], 0
        for i, (c, m) in enumerate(zip(covered, more)):
            if c or m:
                left.append(b[at:i])
                at = i + 1
        left.append(b[at:])
        text = None if text is None else "".join(x.decode("utf-8", "ignore") for x in left if x) if any(covered) or any(more) else text
        out[(d, len(b), sum(covered), runs_of(covered), hashlib.sha256(kept).hexdigest(), sum(more), runs_of(more), text)] += 1
    return out


def check_repeats(df, depth):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert Counter(map(tuple, repeats.repeat_report(df, depth).collect())) == brute_repeats(rows, depth)


def test_passages_of_words(spark):
    """Passages of 51 words and more that are shorter than the byte depth, or have other blanks between their words, are told apart."""
    rng = random.Random(8)
    run = lambda n: ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 4))) for _ in range(n)]
    p, q = run(52), run(50)
    texts = [" ".join(run(60) + p + run(9)), " ".join(run(5)) + " \n" + "\t".join(p), " ".join(q + run(70)), " ".join(run(30) + q), " ".join(run(300)), None]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    check_repeats(docs, 400)
    got = {r["doc_id"]: r["n_passage_spans"] for r in repeats.repeat_report(docs).collect()}
    assert got == {0: 1, 1: 1, 2: 0, 3: 0, 4: 0, 5: 0}


def test_repeats(spark, small_docs, edge_docs, no_docs):
    check_repeats(small_docs, 400)
    check_repeats(edge_docs.filter("doc_id != 10 or doc_id is null"), 20)
    assert repeats.repeat_report(no_docs).count() == 0
    check_repeats(spark.createDataFrame([(1, "ab" * 700), (2, "x" * 900), (3, "é" * 400)], DOCS), 400)


def test_overlapping_passages(spark):
    """Passages that overlap, lie at text ends, repeat within one text, and differ in their surroundings."""
    rng = random.Random(11)
    noise = lambda n: "".join(rng.choice("abcdefghij é") for _ in range(n))
    p, q = noise(90), noise(55)
    texts = [p + noise(70), noise(33) + p, noise(20) + p[:60] + noise(40), noise(9) + p[25:] + q, q + noise(5) + q, p[10:80] + q[:41],
             noise(300), q[3:], q, p + p, "", noise(10)]
    check_repeats(spark.createDataFrame(list(enumerate(texts)), DOCS), 40)


def test_long_text(spark):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefghijklmnop ") for _ in range(300_000))
    docs = spark.createDataFrame([(1, text), (2, text[1000:3000]), (3, text[-500:])], DOCS)
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in repeats.repeat_report(docs).collect()}
    assert got == {1: (2500, 2), 2: (2000, 1), 3: (500, 1)}


def test_drop_repeats(spark, edge_docs):
    passage = "Ein längerer Satz über das Wetter. " * 20
    docs = spark.createDataFrame([(1, "Anfang " + passage, "a"), (2, passage + "é Ende", "b"), (3, "alone " * 3, "c"), (4, None, "d"), (5, passage, "e")],
                                 "doc_id bigint, text string, spans string")
    got = {r["doc_id"]: (r["text"].strip() if r["text"] else r["text"], r["spans"]) for r in repeats.drop_repeats(docs).collect()}
    assert got == {1: ("Anfang", "a"), 2: ("é Ende", "b"), 3: (("alone " * 3).strip(), "c"), 4: (None, "d")}
    assert repeats.drop_repeats(edge_docs).columns == edge_docs.columns


def test_marks_lose_no_link():
    """Cell counts and order bitmaps bound what two sets share, for sets of all sizes and shares."""
    rng = np.random.default_rng(12)
    t = jaccard.THRESHOLD
    weights = rng.integers(0, 20, 1 << jaccard.LOG_CELLS).astype(np.uint8)
    pruned = 0
    for n in (1, 2, 5, 30, 100, 128, 700, 5000):
        for share in (0.0, 0.3, 0.7, 0.86, 0.95, 1.0):
            k = round(n * share)
            both = rng.integers(0, 1 << 63, k, dtype=np.uint64)
            x, y = (np.unique(np.concatenate([both, rng.integers(0, 1 << 63, n - k, dtype=np.uint64)])) for _ in range(2))
            common = len(np.intersect1d(x, y))
            bound = jaccard.most_common(jaccard.cell_marks(x), jaccard.cell_marks(y), len(x), len(y))
            assert bound >= common
            meets = jaccard.orders_meet(*(jaccard.order_bits(s, weights, t, 3) for s in (x, y)))
            if 4 * common >= 3 * (len(x) + len(y) - common):
                assert meets and 4 * bound >= 3 * (len(x) + len(y) - bound)
            elif share < 0.5:
                pruned += not meets or 4 * bound < 3 * (len(x) + len(y) - bound)
    assert pruned >= 10
    same = np.full(40, 7, np.uint64)
    assert jaccard.cell_marks(same) == b"" and jaccard.most_common(b"", jaccard.cell_marks(same[:3]), 40, 3) == 3


def test_only_early_places_are_hubs(spark):
    """Of a pair that links the smaller set has the shared token early; a key of late places only leaves nothing open."""
    docs = spark.createDataFrame(planted(4, 6, 3), DOCS)
    weights = spark.sparkContext.broadcast(np.zeros(1 << jaccard.LOG_CELLS, np.uint8))
    rows = jaccard._members(docs, weights, jaccard.THRESHOLD).collect()
    assert {r["hub"] for r in rows} == {True, False}
    assert all(r["hub"] == (7 * (r["size"] - r["place"]) >= 6 * r["size"]) for r in rows)
    late = spark.createDataFrame([(1, n, 100, 20, False) for n in range(4)], "key long, node long, size long, place long, hub boolean")
    labels = spark.createDataFrame([], "node long, label long")
    assert linking._open(late, labels)[1] == 0


def test_cell_weights(spark):
    """Partial counts of one, two and four bytes come to one weight a cell, and a hundred million tokens leave single ones apart from fours."""
    cells = (1 << jaccard.LOG_CELLS) // jaccard.CELL_ROWS
    parts = [(3, (np.arange(cells) % 7).astype(kind).tobytes()) for kind in (np.uint8, np.uint16, np.uint32)]
    got = jaccard._weights(spark.createDataFrame(parts, "cell_row int, cells binary")).reshape(jaccard.CELL_ROWS, cells)
    assert (got[3] == np.floor(2 * np.log2(3.0 * (np.arange(cells) % 7) + 1))).all() and not got[:3].any() and not got[4:].any()
    assert 1e8 / (1 << jaccard.LOG_CELLS) < 32


def test_scan_memory():
    """A batch is scanned in slices whose arrays take a few megabytes, with the same anchors as at once."""
    import tracemalloc

    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(10 ** 5)}" for _ in range(600)) for _ in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    for depth, unit in ((400, repeats.BYTES), (51, repeats.WORDS)):
        keys = lambda part: repeats._scan(part, depth, unit)[2][3]
        at_once = np.concatenate([keys(p) for p in hashing.text_slices(batch, most=1 << 30)])
        tracemalloc.start()
        try:
            found = [keys(p) for p in repeats._slices(batch)]
            peak = tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()
        assert np.array_equal(np.concatenate(found), at_once) and len(at_once)
        assert peak < 24_000_000, peak
