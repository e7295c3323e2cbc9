"""Cross-tokenizer alignment against a token-by-token count (operator 13)."""

import hashlib
import json
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF0001
from llm_fixtures import awkward, docs, nothing  # noqa: F401
from roomrate.llm import alignment
from roomrate.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def gpt_bytes():
    """The byte-level alphabet, written from its definition."""
    shown = [b for b in range(256) if chr(b).isprintable() and chr(b) != " " and b != 0xAD]
    out, extra = {}, 0
    for b in range(256):
        if b in shown:
            out[chr(b)] = b
        else:
            out[chr(256 + extra)] = b
            extra += 1
    return out


def brute(rows):
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    alphabet = gpt_bytes()
    token = {i: t for t, i in json.load(open(A))["model"]["vocab"].items()}
    per, holds = [], Counter()
    for doc_id, text in rows:
        if not text:
            per.append((doc_id, [], [], []))
            continue
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(alphabet[c] for c in token[i]) for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
                   for i in ids_b for p in [b.id_to_piece(i)]]
        own = b" " + text.encode()
        if b"".join(bytes_a) != own or b"".join(bytes_b) != own:
            per.append((doc_id, [], [], []))
            continue
        groups, i, j, at_a, at_b, ga, gb = [], 0, 0, 0, 0, [], []
        while i < len(ids_a) or j < len(ids_b):
            if at_a <= at_b:
                at_a += len(bytes_a[i])
                ga.append(ids_a[i])
                i += 1
            else:
                at_b += len(bytes_b[j])
                gb.append(ids_b[j])
                j += 1
            if at_a == at_b:
                groups.append((ga, gb))
                ga, gb = [], []
        per.append((doc_id, ids_a, ids_b, groups))
        holds.update({(x, y) for ga, gb in groups for x in ga for y in gb})
    best = defaultdict(int)
    for (x, _), n in holds.items():
        best[x] = max(best[x], n)
    out = []
    for doc_id, ids_a, ids_b, groups in per:
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((doc_id, len(ids_a), len(ids_b), len(groups), len(links),
                    sum(holds[p] == best[p[0]] for p in links), sum(holds[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


def tuples(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def test_query(spark, docs):
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert tuples(QUERIES["op13_token_alignment"](spark, SF0001)) == sorted(want, key=repr)
    assert sum(r[4] for r in want) > sum(r[3] for r in want) > 1000


@pytest.mark.parametrize("limit", [alignment.WIDE_GROUP, 4])
def test_awkward(spark, awkward, nothing, monkeypatch, limit):
    """Null, empty, long and repeated rows, runs, emoji, U+2581, special
    tokens as text; wide groups counted by distinct ids as well."""
    monkeypatch.setattr(alignment, "WIDE_GROUP", limit)
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 1 << 14)
    monkeypatch.setattr(alignment, "MAX_PARTS", 50)
    more = [(20, "a▁b"), (21, "<|endoftext|> <s> <0x0A>"), (22, "  two  spaces \n\n\n and\ttabs "), (23, "👩‍👩‍👧 ‮x"),
            (24, " " * 3000 + "x"), (25, "a" * 3000), (26, "中文字符 한국어 ไทย"),
            (27, "a \x1c b \x85c d\u00a0 e \u2003f \u3000 g"), (28, " lead"), (29, "trail "), (30, "it's  we'll 's  'd x'"),
            (31, "\ttab \t tab\n \n x"), (32, "nul\x00 byte \x00"), (33, "e\u0301 \u0301 \ufb01 \uff21 \u200b z"), (None, "no id"), (20, "again")]
    rows = [(r.doc_id, r.text) for r in awkward.collect()] + more
    df = awkward.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    got = tuples(alignment.align(df, A, B))
    want = sorted(brute(rows), key=repr)
    assert got == want
    assert (20, 0, 0, 0, 0, 0, 0, "") in got and any(r[0] == 20 and r[1] for r in got)
    assert alignment.align(nothing, A, B).count() == 0
    assert alignment.align(awkward.filter("text is null"), A, B).select("n_a", "groups_sha256").first() == (0, "")


def test_groups_are_whole_outputs(spark, docs):
    some = docs.filter("doc_id < 30")
    for r in alignment.groups(some, A, B).collect():
        assert not r.ids_a or (r.ends_a[-1], r.ends_b[-1]) == (len(r.ids_a), len(r.ids_b))
        text = ";".join(
            ",".join(map(str, r.ids_a[x:x2])) + "|" + ",".join(map(str, r.ids_b[y:y2]))
            for x, x2, y, y2 in zip([0, *r.ends_a], r.ends_a, [0, *r.ends_b], r.ends_b))
        own = hashlib.sha256(text.encode()).hexdigest() if text else ""
        want = alignment.align(some, A, B).filter(F.col("doc_id") == r.doc_id).first() if r.doc_id == 3 else None
        assert want is None or want.groups_sha256 == own


def test_very_long_runs(spark):
    rows = [(1, " " * 300_000), (2, "é" * 100_000), (3, "\n" * 100_000), (4, "ab " * 100_000)]
    got = tuples(alignment.align(spark.createDataFrame(rows, "doc_id long, text string"), A, B))
    assert got == sorted(brute(rows), key=repr)


def test_common_cuts():
    assert alignment.common_cuts([2, 5, 6, 9], [1, 2, 6, 7, 9]) == ([1, 3, 4], [2, 3, 5])
    assert alignment.common_cuts([], []) == ([], [])


def test_pieces_of_a_block(monkeypatch):
    """Links a few documents at a time, and blocks a piece at a time, are those
    of the whole block."""
    import numpy as np

    with open(A, "rb") as a, open(B, "rb") as b:
        tok = alignment.Tokenizers(a.read(), b.read())
    texts = ["", "one two  three", "é" * 50, "the same words the same words", "\n", "x" * 200, "last one"] * 4
    whole = alignment.Block(tok, texts)
    keys, times = whole.links()
    monkeypatch.setattr(alignment, "SOME_LINKS", 7)
    monkeypatch.setattr(alignment, "PIECE_BYTES", 60)
    some = [x.tolist() for x in whole.links()]
    assert some == [keys.tolist(), times.tolist()]
    raw = [t.encode() for t in texts]
    got = alignment._aligned(tok, np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert [x.tolist() for x in got[0]] == [x.tolist() for x in (whole.n_a, whole.n_b, whole.n_groups, whole.n_links)]
    assert got[1] == whole.hashes() and [x.tolist() for x in got[2:]] == some


def test_one_block_at_a_time(spark, docs, monkeypatch):
    """Files hold few blocks, as a reader holds all rows of one; blocks meet
    their counts one by one, not many collected lists in a task."""
    made, own, blocks = [], alignment.staged, alignment.blocks
    monkeypatch.setattr(alignment, "staged", lambda df, name, *n: (made.append(own(df, name, *n)), made[-1])[1])
    few = docs.limit(3)
    many = few.unionByName(few).repartition(1)
    monkeypatch.setattr(alignment, "blocks", lambda *a: blocks(*a).crossJoin(
        spark.range(9, numPartitions=1).select((F.col("id") * 1000).alias("more"))).withColumn(
        "block", F.col("block") + F.col("more")).drop("more").coalesce(1))
    got = alignment.align(many, A, B)
    assert "collect_list" not in got._jdf.queryExecution().toString()
    files = made[0].groupBy(F.input_file_name()).count().collect()
    assert sum(f["count"] for f in files) == 9 and max(f["count"] for f in files) <= alignment.FILE_BLOCKS
    assert got.count() == 9 * 6
