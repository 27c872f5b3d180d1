"""Personal data against a plain scan with Python's patterns, and the added spans of hand-made texts."""

import hashlib
import random
import re
import time

import pytest

from shelfspark.llm import personal

BASE = {"email": personal.EMAIL, "ip": personal.IP, "card": personal.CARD, "phone": personal.PHONE}


def luhn(digits):
    return sum(int(d) if i % 2 == 0 else int(d) * 2 - 9 * (int(d) > 4) for i, d in enumerate(reversed(digits))) % 10 == 0


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in value.split(".")),
            "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]


def brute(text):
    return sorted((m.start(), personal.KINDS.index(k), m.end()) for k, p in BASE.items() for m in re.finditer(p, text or "") if passes(k, m[0]))


def check(df):
    want = sorted((str(r["doc_id"]), *base_columns(r["text"])) for r in df.collect())
    got = personal.personal_report(df).collect()
    assert sorted((str(r["doc_id"]), r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in got) == want
    return got


def base_columns(text):
    spans = brute(text)
    joined = ",".join(f"{personal.KINDS[k]}:{a}:{b}" for a, k, b in spans)
    return *(sum(s[1] == k for s in spans) for k in range(4)), hashlib.sha256(joined.encode()).hexdigest()


def of_texts(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def test_given_and_edge_documents(spark, small_docs, edge_docs, no_docs):
    got = check(small_docs)
    assert sum(r["n_email"] for r in got) and sum(r["n_ip"] for r in got) and sum(r["n_phone"] for r in got)
    check(edge_docs)
    assert personal.personal_report(no_docs).collect() == []


def test_base_spans_of_random_texts(spark):
    rng = random.Random(5)
    bits = ["a@b.c", "x.y@d-e.f.g", "@", ".", "1.2.3.4", "300.1.1.1", "001.02.3.255", "4111 1111 1111 1111", "4111111111111111", "+1 (663) 555-6869",
            "+", "-", " ", "  ", "(", "7", "99", "é", "東", "🙂", "_", "a", "\n", "+49 30 1234567", "378282246310005", "0" * 16, "5.", ".com"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 40))) for _ in range(400)]
    check(of_texts(spark, [*texts, "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "a@b.c.@d.e", "+1 2", "+12345678901234567", "a" * 50 + "@x", ""]))


ADDED = [
    ("Pay to DE89 3704 0044 0532 0130 00 IS fine", "iban:7:34"),
    ("GB29NWBK60161331926819", "iban:0:22"),
    ("GB29NWBK60161331926818 is wrong", ""),
    ("xGB29NWBK60161331926819", ""),
    ("GB29NWBK60161331926819A", ""),
    ("my social security no 219-09-9999.", "ssn:22:33"),
    ("part 219-09-9999", ""),
    ("ssn 000-09-9999 and ssn 219-00-9999", ""),
    ("call (663) 555-6869 now", "phone:5:19"),
    ("item (663) 555-6869 now", ""),
    ("call +1 (663) 555-6869", "phone:5:22"),
    ("twice 4111111111111111 4111111111111111", "card:6:22,card:23:39"),
    ("tracking 4111111111111111 4111111111111111 ", "card:26:42"),
    ("twice 4111111111111112 4111111111111112", ""),
    ("card 4111-1111-1111-1111 é x@y.zz", "card:5:24,email:27:33"),
]


def test_added_spans(spark):
    got = personal.personal_report(of_texts(spark, [t for t, _ in ADDED])).orderBy("doc_id").collect()
    assert [r["spans"] for r in got] == [s for _, s in ADDED]
    assert [r["n_added"] for r in got] == [1, 1, 0, 0, 0, 1, 0, 0, 1, 0, 0, 2, 1, 0, 0]


@pytest.mark.parametrize("text", ["a" * 1_000_000, "1" * 1_000_000, "a." * 300_000 + "@b", "x@" + "a." * 300_000, "1." * 300_000, "+1" + " (" * 300_000,
                                  "1.2.3.4 " * 20_000, "AA11" * 200_000, "4 " * 400_000, "GB29NWBK60161331926819 a@b.cc " * 3_000])
def test_long_texts_take_time_in_proportion(spark, text):
    began = time.time()
    got = personal.personal_report(of_texts(spark, [text])).collect()[0]
    assert time.time() - began < 60
    if len(text) < 250_000:
        assert (got["n_email"], got["n_ip"], got["n_card"], got["n_phone"], got["base_sha256"]) == base_columns(text)
