"""The corpus pipeline stage by stage against brute force, and its edge cases."""

import random
import re
from collections import Counter

import corpus_pipeline
from llm.test_duplicates import brute_classes
from llm.test_lines import brute as brute_lines
from llm.test_native_documents import brute_quality

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
BLANK = " \t\n\x0b\x0c\r"


def rows_of(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def made(seed=4):
    """Clean documents, short and repetitive junk, near copies, shared lines and a shared long passage."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmno") for _ in range(rng.randint(3, 8)))
    line = lambda: " ".join(word() for _ in range(rng.randint(6, 14)))
    clean = ["\n".join(line() for _ in range(rng.randint(3, 8))) for _ in range(30)]
    passage = " ".join(word() for _ in range(90))
    shared = line()
    texts = list(clean) + ["too short", "", None, ("again and again we say " * 30).strip()]
    for _ in range(4):
        t = clean[0].split(" ")
        t[rng.randrange(len(t))] = word()
        texts.append(" ".join(t))
    texts += [line() + "\n" + line() + "\n" + shared for _ in range(4)]
    texts += [line() + " " + line() + " " + passage + " " + line() for _ in range(3)]
    return [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)], set(range(1, 30))


def brute_stages(rows):
    rows = [(d, t) for d, t in rows if not brute_quality(t or "")[5]]
    yield dict(rows)
    keep = {(d, n) for (d, n, _, _, kept) in brute_lines(rows, 2) if kept}
    cleaned = []
    for d, t in rows:
        parts = t.split("\n")
        left = [x for n, x in enumerate(parts) if not x.strip(BLANK) or (d, n) in keep]
        if len(left) == len(parts) or "".join(left).strip(BLANK):
            cleaned.append((d, "\n".join(left)))
    yield dict(cleaned)
    one = {d for d, _, c in brute_classes(cleaned) if d == c}
    cleaned = [(d, t) for d, t in cleaned if d in one]
    yield dict(cleaned)
    count = Counter(b[i:i + 400] for _, t in cleaned for b in [t.encode()] for i in range(len(b) - 399))
    out = []
    for d, t in cleaned:
        b = t.encode()
        gone = set()
        for i in range(len(b) - 399):
            if count[b[i:i + 400]] > 1:
                gone.update(range(i, i + 400))
        left = bytes(x for i, x in enumerate(b) if i not in gone).decode("utf-8", "ignore")
        if not gone or left.strip(BLANK):
            out.append((d, left))
    yield dict(out)


def test_stages_match_brute_force(spark):
    rows, clean = made()
    docs = spark.createDataFrame(rows, DOCS)
    want = brute_stages([(r[0], r[1]) for r in rows])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        got, expected = rows_of(docs), next(want)
        assert got == expected
        assert clean <= set(got)
    texts = rows_of(docs)
    assert all(texts[d] == rows[d][1] for d in clean)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert {r["doc_id"] for r in packed} == set(texts)


def brute_passages(rows, n):
    """Texts without the windows of n words that start at two places, cut from their first word to their last."""
    spans = {d: [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", t)] for d, t in rows}
    windows = {d: [tuple(t[a:b] for a, b in spans[d][i:i + n]) for i in range(len(spans[d]) - n + 1)] for d, t in rows}
    count = Counter(w for ws in windows.values() for w in ws)
    out = {}
    for d, t in rows:
        gone = {x for i, w in enumerate(windows[d]) if count[w] > 1 for x in range(spans[d][i][0], spans[d][i + n - 1][1])}
        left = "".join(c for i, c in enumerate(t) if i not in gone)
        if not gone or left.strip(BLANK):
            out[d] = left
    return out


def test_passages_of_over_fifty_words(spark):
    """Passages of 51 to 60 short words, under 400 bytes, go from documents that share them; of 50 words they stay."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghé") for _ in range(rng.randint(1, 4)))
    run = lambda n: [word() for _ in range(n)]
    texts = [" ".join(run(200)) for _ in range(5)]
    for n in (50, 51, 55, 60):
        p = run(n)
        assert len(" ".join(p).encode()) < 400
        texts += [" ".join(run(70) + p + run(70)), " ".join(run(70)) + " \n" + "\t".join(p) + "\n" + " ".join(run(70)), " ".join(run(70) + p)]
    p = run(58)
    texts += [" ".join(p + run(90)), " ".join(p), " ".join(run(50) + p[3:56] + run(50) + p[:54])]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(d, t, "en", "src", len(t)) for d, t in rows], DOCS)
    got = rows_of(dict(corpus_pipeline.STAGES)["suffix_array_dedup"](spark, docs, ""))
    assert got == brute_passages(rows, 51)
    assert [got[d] == texts[d] for d in range(17)] == [True] * 8 + [False] * 9 and 18 not in got


def test_run_over_given_documents(spark):
    from shelfspark.session import get_session  # noqa: F401

    packed = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert packed.count() > 100
    assert max(r["s"] for r in packed.groupBy("sequence_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "s").collect()) <= 2048


def test_edges_pass_through_all_stages(spark, edge_docs, no_docs):
    # All edge rows are short or repetitive: their hosts are rejected, so clean documents of another host go along.
    clean = lambda d: " ".join(f"word{d}x{i}" for i in range(60))
    more = [(d, clean(d), "en", h, 0, "x", 3, "y") for d, h in ((49, "src0"), (50, "src1"), (51, "src1"), (52, "src1"))]
    docs = edge_docs.unionByName(spark.createDataFrame(more, edge_docs.schema))
    assert {r["doc_id"] for r in corpus_pipeline.STAGES[0][1](spark, docs, "").collect()} == {50, 51, 52}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, no_docs, "").count() == 0
        docs = stage(spark, docs, "")
        assert docs.columns == edge_docs.columns, name
    assert not re.search("_doc|_key", " ".join(docs.columns))
    assert [r["doc_id"] for r in corpus_pipeline.STAGES[-1][1](spark, docs, "").orderBy("doc_id").collect()] == [50, 51, 52]


def test_quality_plan_stays_small(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = dict(corpus_pipeline.STAGES)["quality_rules"](spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 20_000 and plan.count("Exchange") <= 4
