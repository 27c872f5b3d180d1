"""Centroid clustering against plain rounds in Python integers, and the bounds against full drift."""

import hashlib
import math
import random
from collections import Counter

import numpy as np

from shelfspark.llm import centroids

VECTORS = "vec_id bigint, embedding array<float>, label int, cluster int, point string, low int"


def brute(rows, clusters=16, rounds=3):
    kept = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) and abs(x) <= 2 ** 21 for x in v)]
    if not kept:
        return Counter()
    name = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    now = [p for _, p in sorted((name(i), p) for i, p in kept)[:clusters]]

    def assign():
        out = []
        for _, p in kept:
            d = [sum((a - b) ** 2 for a, b in zip(p, c)) for c in now]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        got = assign()
        for c in range(len(now)):
            own = [p for (_, p), (k, _) in zip(kept, got) if k == c]
            if own:
                now[c] = [sum(x) // len(own) for x in zip(*own)]
    got = assign()
    inertia = Counter()
    for c, d in got:
        inertia[c] += d
    return Counter((i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, now[c])).encode()).hexdigest())
                   for (i, _), (c, d) in zip(kept, got))


def check(spark, rows):
    df = spark.createDataFrame([(i, v, 1, 2, "x", 3) for i, v in rows], VECTORS)
    rounded = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert Counter(tuple(r) for r in centroids.cluster_report(df).collect()) == brute(rounded)


def test_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert Counter(tuple(r) for r in centroids.cluster_report(df).collect()) == brute([(r["vec_id"], r["embedding"]) for r in df.collect()])


def test_edges(spark):
    rng = random.Random(3)
    vector = lambda: [rng.gauss(0, 0.2) for _ in range(64)]
    odd = [None, [], vector()[:63], vector() + [0.0], [None] + vector()[1:], [math.nan] + vector()[1:], [math.inf] + vector()[1:], [1e30] + vector()[1:]]
    same = vector()
    rows = [(k, v) for k, v in enumerate(odd)] + [(None, vector()), (None, vector()), (7, same), (7, same), (8, [0.0] * 64), (9, [-0.0] * 64)]
    check(spark, rows)
    check(spark, rows[:8])
    check(spark, rows[10:13])
    check(spark, [])


def test_hot_copies_ties_and_clusters(spark):
    """A third of all rows is one vector, more sit half way between centroids, and the rest lie in blobs far apart."""
    rng = random.Random(4)
    blobs = [[rng.choice((-3.0, 3.0)) for _ in range(64)] for _ in range(20)]
    rows = [(d, blobs[0]) for d in range(300)] + [(1000 + d, [x + rng.gauss(0, 0.05) for x in blobs[d % 20]]) for d in range(500)]
    rows += [(3000 + d, [(d % 5) / 64] + [0.0] * 63) for d in range(100)]
    check(spark, rows)


def test_bounds_hold_and_beat_full_drift():
    rng = np.random.default_rng(1)
    full = tight = 0.0
    for _ in range(300):
        before = rng.normal(size=(4, 6)) * 5
        after = before + rng.normal(size=(4, 6)) * rng.choice([0.1, 1, 4])
        radii = np.abs(rng.normal(size=4)) * 3
        loosen = centroids.loosening(before, after, radii)
        for i in range(4):
            way = rng.normal(size=(200, 6))
            x = before[i] + way / np.linalg.norm(way, axis=1)[:, None] * radii[i] * rng.random((200, 1)) ** 0.2
            others = [j for j in range(4) if j != i]
            change = lambda j: np.linalg.norm(x - before[j], axis=1) - np.linalg.norm(x - after[j], axis=1)
            assert max(change(j).max() for j in others) <= loosen[i] + 1e-12
            drift = max(np.linalg.norm(after[j] - before[j]) for j in others)
            full, tight = full + drift, tight + loosen[i]
    assert tight < 0.85 * full


def test_passes_skip_most_vectors(spark):
    rng = np.random.default_rng(2)
    blobs = rng.normal(size=(16, 64))
    rows = [(d, (blobs[d % 16] + rng.normal(size=64) * 0.1).tolist()) for d in range(3000)]
    df = spark.createDataFrame([(i, v, 1, 2, "x", 3) for i, v in rows], VECTORS)
    scans = centroids.cluster_vectors(df, "vec_id", "embedding")[2]
    assert scans[0] == 3000 and scans[-1] < 1500
