"""Personal data against Python's re (operator 1)."""

import hashlib
import random
import re
import time
from itertools import accumulate

import pytest
import regex
from pyspark.sql import functions as F

from conftest import SF0001
from llm_fixtures import awkward, docs, nothing  # noqa: F401
from roomrate.llm import pii
from roomrate.llm.queries import QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (2 if i % 2 else 1)
        s += x - 9 if x > 9 else x
    return s % 10 == 0


def brute(text):
    out = []
    for rank, (kind, p) in enumerate(PATTERNS.items()):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or
                    kind == "card" and not (14 <= len(d) <= 19 and luhn(d)) or
                    kind == "phone" and not 10 <= len(d) <= 15):
                continue
            out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


def rows(df):
    return sorted((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in df.collect())


def want(df):
    out = []
    for r in df.collect():
        s = brute(r.text)
        n = [sum(x[3] == k for x in s) for k in PATTERNS]
        text = ",".join(f"{k}:{a}:{b}" for a, _, b, k in s)
        out.append((r.doc_id, *n, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out)


def test_query(spark, docs):
    got = QUERIES["op1_personal_data"](spark, SF0001)
    assert got.columns[:7] == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    assert rows(got) == want(docs)
    for r in got.collect():  # base spans are among all spans
        assert sum(r[f"n_{k}"] for k in PATTERNS) <= len([x for x in r.spans.split(",") if x])


def test_awkward(awkward, nothing):
    got = pii.digest(pii.find(awkward))
    assert rows(got) == want(awkward)
    assert pii.digest(pii.find(nothing)).count() == 0


def test_random_strings(spark):
    rng = random.Random(9)
    bits = ["a", "b@", "@", ".", "co", "_", "%", "-", " ", "  ", "1", "25", "255", "256", "0", ".1", "+", "+1", "(",
            ")", "4539148803436467", "4539 1488 0343 6467", "98055", "\x01", "é", "中", "\n", "x.y", "0.0.0.0"]
    texts = [(i, "".join(rng.choices(bits, k=rng.randint(1, 30)))) for i in range(3000)]
    texts += [(5000, "a" * 50_000), (5001, "1." * 20_000), (5002, "a@b" + ".c" * 20_000), (5003, "9" * 50_000),
              (5004, "+1" + " 2" * 20_000), (5005, "1.2.3.4 " * 2_000)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(8)
    assert rows(pii.digest(pii.find(df))) == want(df)


def test_added_spans(spark):
    text = ("write to bob (at) example (dot) com or call (980) 555-6268, version 10-20-2024; "
            "ssn 219-09-9999, token = \"0c8b45435718dcc700c184a7e303cdc64c6a8f7f\" end")
    df = spark.createDataFrame([(i, text) for i in range(40)], "doc_id long, text string")
    found = pii.find(df).first()
    values = {(s.kind, s.value.strip()) for s in found.spans}
    assert found.base == []
    assert ("email", "bob (at) example (dot) com") in values
    assert any(k == "secret" for k, _ in values) and any(k == "ssn" for k, _ in values)
    assert all(text[s.start:s.end] == s.value for s in found.spans)


def test_estimate_prefers_the_labelers_that_agree():
    patterns = [("phone", (1, 1, 1, 1), 80), ("phone", (-1, -1, 0, 1), 60), ("phone", (1, -1, 0, -1), 5)]
    post = pii.estimate(patterns)
    assert post[("phone", (1, 1, 1, 1))] > 0.9 > 0.1 > post[("phone", (-1, -1, 0, 1))]


@pytest.mark.parametrize("n", ["4539148803436467", "79927398713", "0", "18"])
def test_luhn(spark, n):
    assert spark.range(1).select(pii.luhn(F.lit(n))).first()[0] == luhn(n)


def loose_brute(text):
    """Loose candidates: matches of the loose patterns that overlap no base span."""
    text = (text or "").replace("\x01", "\x02")
    base = brute(text)
    out = []
    for kind, p in pii.LOOSE.items():
        for m in regex.finditer(p, text):
            if not any(m.start() < e and s < m.end() for s, _, e, _ in base):
                out.append((kind, m.start(), m.end(), m[0]))
    return sorted(out)


def test_candidates_equal_brute_force(spark, docs, awkward):
    rng = random.Random(21)
    bits = ["a", "bob@x.com", "bob (at) x (dot) org", "@", "(555) 234-5678", "219-09-9999", "token=", "0c8b45435718dcc700c1",
            "password: ", "GB82 WEST 1234 5698 7654 32", " ", "\n", "10.0.0.1", "+1 980 555 6268", "4539 1488 0343 6467", "é", "\x01",
            "secret=" + "ab12" * 120, "z" * 50 + "@" + "a." * 12 + "com"]
    rows = [(i, "".join(rng.choices(bits, k=rng.randint(1, 25)))) for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for table in (df, docs, awkward):
        texts = {}
        for r in table.select("doc_id", "text").collect():
            texts.setdefault(r.doc_id, r.text)
        for r in pii.candidates(table, "doc_id", "text").collect():
            assert sorted((s.kind, s.start, s.end, s.value) for s in r.loose) == loose_brute(texts[r.doc_id])


def test_a_long_secret_is_whole(spark):
    secret = "token = " + "a1b2c3d4" * 100
    df = spark.createDataFrame([(i, f"x {secret} y") for i in range(30)], "doc_id long, text string")
    found = pii.find(df).first()
    assert [(s.kind, s.value) for s in found.spans] == [("secret", secret)]


def test_cost_is_linear_in_matches(spark):
    """200,000 matches in one text, base and loose ones between them."""
    n = 100_000
    df = spark.createDataFrame([(0, "1.2.3.4 219-09-9999 " * n)], "doc_id long, text string")
    began = time.time()
    r = pii.digest(pii.find(df)).first()
    assert r.n_ip == n and time.time() - began < 120
    text = ",".join(f"ip:{20 * i}:{20 * i + 7}" for i in range(n))
    assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 128, 4096, 4097, 9000])
def test_running_totals(spark, n):
    rng = random.Random(n)
    values = [rng.randrange(100) for _ in range(n)]
    df = spark.createDataFrame([(values,)], "x array<int>")
    add = df.select(pii.running(F.col("x"), lambda a, b: a + b, F.lit(0)).alias("r")).first().r
    top = df.select(pii.running(F.col("x"), lambda a, b: F.greatest(a, b), F.lit(0)).alias("r")).first().r
    assert add == list(accumulate(values)) and top == list(accumulate(values, max))
