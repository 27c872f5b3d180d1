"""Line classes by the segment-partition edit join against a plain edit distance over all pairs."""

import random
from collections import Counter

import numpy as np
import pytest

from shelfspark.llm import lines

DOCS = "doc_id bigint, text string"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def symbols(s):
    return np.frombuffer(s.encode("utf-32-le"), "<u4")


def edited(rng, s, n, letters="abcd é東"):
    s = list(s)
    for _ in range(n):
        k, at = rng.randrange(3), rng.randrange(len(s) + 1)
        if k == 0:
            s.insert(at, rng.choice(letters))
        elif s and at < len(s):
            s[at:at + 1] = [] if k == 1 else [rng.choice(letters)]
    return "".join(s)


@pytest.mark.parametrize("edits", [0, 1, 2, 3])
def test_banded_distance(edits):
    rng = random.Random(edits)
    for _ in range(1500):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 14)))
        b = edited(rng, a, rng.randrange(0, 6), "abc")
        assert lines.within(symbols(a), symbols(b), edits) == (distance(a, b) <= edits), (a, b)


def brute(rows, edits):
    blank = lambda x: not x.strip(" \t\n\x0b\x0c\r")
    found = [(d, t, n, x) for d, t in rows for n, x in enumerate((t or "").split("\n")) if t is not None and not blank(x)]
    texts = sorted({f[3] for f in found})
    parent = {x: x for x in texts}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    long = [x for x in texts if len(x) >= lines.SHORTEST]
    for i, a in enumerate(long):
        for b in long[:i]:
            if abs(len(a) - len(b)) <= edits and top(a) != top(b) and distance(a, b) <= edits:
                parent[top(a)] = top(b)
    key = lambda d, n: (d is not None, d or 0, n)
    first = {}
    for d, _, n, x in found:
        first[top(x)] = min(first.get(top(x), (True, 1 << 60, 0)), key(d, n))
    return Counter((d, n, first[top(x)][1] if first[top(x)][0] else None, first[top(x)][2], key(d, n) == first[top(x)]) for d, _, n, x in found)


def check(df, edits=2):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert Counter(map(tuple, lines.line_report(df, edits).collect())) == brute(rows, edits)


def planted(rng):
    base = ["".join(rng.choice("abcd é東") for _ in range(rng.randrange(11, 45))) for _ in range(25)]
    texts = []
    for _ in range(60):
        own = [edited(rng, rng.choice(base), rng.choice([0, 0, 1, 1, 2, 3, 4])) for _ in range(rng.randrange(1, 5))]
        texts.append("\n".join([*own, *rng.choice([[], [""], ["short"], ["  "]])]))
    return list(enumerate(texts))


@pytest.mark.parametrize("edits", [1, 2])
def test_planted_lines(spark, edits):
    check(spark.createDataFrame(planted(random.Random(edits)), DOCS), edits)


def test_edges(spark, edge_docs, no_docs):
    check(edge_docs)
    assert lines.line_report(no_docs).count() == 0
    same = "exactly the same line of some length"
    check(spark.createDataFrame([(i, f"{same}\n{same[:-1]}\nunlike {i * 7919}") for i in range(40)], DOCS))


def test_given_documents(small_docs):
    got = lines.line_report(small_docs)
    rows = [(r["doc_id"], r["text"]) for r in small_docs.collect()]
    exact = Counter(x for _, t in rows for x in t.split("\n") if x.strip())
    kept = got.filter("kept").count()
    assert got.count() == sum(exact.values()) and 0 < kept <= len(exact)


def test_drop_lines(spark, edge_docs):
    docs = spark.createDataFrame(
        [(1, "first line of text here\n\nsecond line of text", "a"), (2, "first line of text hero\nown words in this line", "b"),
         (3, "second line of texts", "c"), (4, "", "d"), (5, None, "e"), (None, "own words in this line", "f")],
        "doc_id bigint, text string, _gone string")
    got = {r["doc_id"]: (r["text"], r["_gone"]) for r in lines.drop_lines(docs).collect()}
    assert got == {1: ("first line of text here\n\nsecond line of text", "a"), 4: ("", "d"), 5: (None, "e"), None: ("own words in this line", "f")}
    assert lines.drop_lines(edge_docs).columns == edge_docs.columns
