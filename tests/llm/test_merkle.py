"""The Merkle manifest against a plain tree, for full, partial and single-row trees of up to three recursions."""

import hashlib
import zlib
from collections import Counter

import pytest

from shelfspark.llm import merkle

H = lambda s: hashlib.sha256(s.encode()).hexdigest()


def value(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def climb(nodes):
    """Levels of a tree, from its nodes to its last one."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H("".join(last[i:i + 16])) for i in range(0, len(last), 16)])
    return levels


def segments(levels, i):
    out = []
    for level in levels[:-1]:
        a = i - i % 16
        out.append(("".join(level[a:i]), "".join(level[i + 1:a + 16])))
        i //= 16
    return out


def brute(rows):
    trees = {}
    for r in rows:
        doc, text = r["doc_id"], r["text"]
        leaf = lambda t: H("".join(map(value, (doc, r["source"], r["lang"], r["n_chars"], t))))
        tampered = doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0 and text is not None
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        trees.setdefault(r["source"], []).append((doc is not None, doc or 0, leaf(text), leaf(low) if tampered else leaf(text), doc))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    levels = {s: climb([x[2] for x in sorted(trees[s], key=lambda x: x[:3])]) for s in names}
    top = climb([levels[s][-1][0] for s in names])
    root = top[-1][0]
    for k, s in enumerate(names):
        for i, (_, _, leaf, other, doc) in enumerate(sorted(trees[s], key=lambda x: x[:3])):
            path = segments(levels[s], i) + segments(top, k)
            node = other
            for left, right in path:
                node = H(left + node + right)
            yield doc, leaf, levels[s][-1][0], root, H("".join(a + b for a, b in path)), node, node == root


def check(df):
    got = Counter(tuple(r) for r in merkle.manifest_report(df).collect())
    want = Counter(brute(df.collect()))
    assert got == want


def test_edges(spark, edge_docs, no_docs):
    check(edge_docs)
    assert merkle.manifest_report(no_docs).collect() == []
    check(edge_docs.limit(1))


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.mark.parametrize("sizes", [[1], [2], [16], [17], [256], [257, 1, 16], [273, 300], [4096 + 1, 600, 3]])
def test_tree_shapes(spark, sizes):
    rows = [(d * 7, f"Text {d}", None, f"s{k}", d) for k, n in enumerate(sizes) for d in range(n)]
    check(spark.createDataFrame(rows, DOCS))


def test_many_sources_and_hot_rows(spark):
    """A third of all rows in one source, a third without an id, rows that repeat, and 700 sources."""
    rows = [(d, "A b", "en", "hot" if d % 3 else f"é{d}", 3) for d in range(2000)]
    rows += [(None, f"T{d}" if d % 2 else "same", "en", None, d % 2) for d in range(1000)]
    check(spark.createDataFrame(rows, DOCS).repartition(7))
