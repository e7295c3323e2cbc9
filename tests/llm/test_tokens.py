"""Section token counts against a token-by-token count (operator 2)."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from conftest import SF0001
from llm_fixtures import awkward, docs, nothing  # noqa: F401
from roomrate.llm import bpe, tokens
from roomrate.llm.queries import QUERIES, bpe_vocabulary


@pytest.fixture(scope="module")
def reference():
    with open(bpe_vocabulary(), "rb") as f:
        ranks = bpe.parse_ranks(f.read())
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    back = {r: t for t, r in ranks.items()}
    return lambda text: [back[i] for i in enc.encode_ordinary(text)]


def brute(toks, text, start, end, rule):
    data = text.encode()
    owner, n = [], -1  # character of each byte
    for b in data:
        n += (b & 0xC0) != 0x80
        owner.append(n)
    total, at = 0.0, 0
    for t in toks:
        chars = owner[at:at + len(t)]
        inside = [start <= c < end for c in chars]
        if rule == "start":
            total += inside[0]
        elif rule == "fraction":
            total += sum(inside) / len(t)
        else:
            total += 2 * sum(inside) > len(t) or 2 * sum(inside) == len(t) and inside[0]
        at += len(t)
    return total


def line_spans(text):
    out, at = [], 0
    parts = text.split("\n")
    for i, x in enumerate(parts):
        end = at + len(x) + (i < len(parts) - 1)
        out.append((at, end))
        at = end
    return out


@pytest.mark.parametrize("rule", tokens.RULES)
def test_lines(docs, awkward, reference, rule):
    rows = [r for r in docs.collect() if len(r.text) < 3000][:40]
    for df, texts in ((docs.filter(F.col("doc_id").isin([r.doc_id for r in rows])), {r.doc_id: r.text for r in rows}),
                      (awkward,
                       {r.doc_id: r.text or "" for r in awkward.collect()})):
        got = tokens.section_tokens(df, bpe_vocabulary(), rule=rule).collect()
        for r in got:
            text = texts[r.doc_id]
            assert (r.start, r.end) == line_spans(text)[r.section_no]
            toks = reference(text)
            assert r.doc_tokens == len(toks)
            assert r.n_tokens == pytest.approx(brute(toks, text, r.start, r.end, rule))
        assert {r.doc_id for r in got} == set(texts)


def test_query_counts_every_token_once(spark, docs, reference):
    got = QUERIES["op2_section_tokens"](spark, SF0001)
    per = {r.doc_id: (r.n, r.d) for r in got.groupBy("doc_id").agg(F.sum("n_tokens").alias("n"),
                                                                  F.max("doc_tokens").alias("d")).collect()}
    assert per == {r.doc_id: (len(reference(r.text)),) * 2 for r in docs.collect()}


@pytest.mark.parametrize("rule", tokens.RULES)
def test_given_sections(spark, reference, rule):
    rng = random.Random(3)
    texts = {i: "".join(rng.choices(["naïve ", "中文", "🙂", "token ", "s, ", "\n"], k=30)) for i in range(20)}
    spans = [(i, f"s{j}", a, a + rng.randrange(12)) for i in texts for j in range(4)
             for a in [rng.randrange(len(texts[i]))]]
    spans += [(0, "all", None, None), (0, "beyond", 10**6, 10**6 + 5), (99, "nobody", 0, 1)]
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("start", F.lit(1))
    sections = spark.createDataFrame(spans, "doc_id long, section string, start int, end int")
    got = tokens.section_tokens(df, bpe_vocabulary(), sections, rule).collect()
    want = {(i, s): brute(reference(texts[i]), texts[i], a or 0, len(texts[i]) if b is None else b, rule)
            for i, s, a, b in spans if i in texts}
    assert {(r.doc_id, r.section): r.n_tokens for r in got} == pytest.approx(want)


def test_nothing(nothing):
    assert tokens.section_tokens(nothing, bpe_vocabulary()).count() == 0
    assert np.array_equal(tokens.allocate(np.zeros(0, int), np.array([0]), np.array([5]), "start"), [0])


def test_long_runs(spark, reference):
    """Runs of a megabyte, alone and inside a text; tokens as the transducer
    gives them, and as the library does where it can."""
    million = 1_000_000
    texts = [" " * million, "a" * million, "!" * million, "\n" * million, "x" + " " * million + "y\nz" + "é" * million,
             "1" * million, "short text\nof two lines"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in tokens.section_tokens(df, bpe_vocabulary()).collect():
        got.setdefault(r.doc_id, []).append((r.section_no, r.n_tokens, r.doc_tokens))
    with open(bpe_vocabulary(), "rb") as f:
        enc = bpe.Encoder(bpe.parse_ranks(f.read()), public_tokenizers.PATTERN)
    for i, t in enumerate(texts):
        whole = len(enc.encode(t))
        assert {x[2] for x in got[i]} == {whole} and sum(x[1] for x in got[i]) == whole
        assert len(got[i]) == t.count("\n") + 1
    assert len(reference(texts[6])) == len(enc.encode(texts[6]))
