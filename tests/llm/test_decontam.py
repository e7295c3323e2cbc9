"""Benchmark windows against brute force (operator 8)."""

import hashlib
import re

import pytest

from conftest import SF0001
from llm_fixtures import awkward, docs, nothing  # noqa: F401
from roomrate.llm import decontam
from roomrate.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    out = []
    patterns = {}
    for item, text in items:
        w = words(text)
        m = min(len(w), window)
        for i in range(len(w) - m + 1) if w else ():
            patterns.setdefault(tuple(w[i:i + m]), set()).add(item)
    lengths = {len(p) for p in patterns}
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for m in lengths:
            for i in range(len(w) - m + 1):
                ids = patterns.get(tuple(w[i:i + m]))
                if ids:
                    hit.update(range(i, i + m))
                    found |= ids
        names = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def test_query(spark):
    d = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    b = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    got = QUERIES["op8_decontamination"](spark, SF0001)
    want = brute(d, b)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert any(x[5] for x in want)


def test_awkward(spark, awkward, nothing):
    items = [(1, "one two three"), (2, None), (3, ""), (4, "Alpha"), (5, "a" * 100_000), (None, "BOB"),
             (6, "two three four five six seven eight nine ten eleven twelve"), (7, "One, two? THREE!"), (1, "straße")]
    bench = spark.createDataFrame(items, "item_id int, text string").withColumn("items", decontam.F.lit(0))
    got = decontam.contamination(awkward, bench)
    rows = sorted((r.doc_id, r.n_words, r.n_hit, len(r["items"]),
                   hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.contaminated) for r in got.collect())
    assert rows == brute([(r.doc_id, r.text) for r in awkward.collect()], items)
    assert decontam.contamination(nothing, bench).count() == 0
    none = decontam.contamination(awkward, bench.limit(0)).collect()
    assert len(none) == awkward.count() and not any(r.contaminated for r in none)


def test_blocks_and_drop(spark, docs, awkward, monkeypatch):
    bench = spark.read.parquet(f"{SF0001}/benchmark.parquet")
    whole = {tuple(map(str, r)) for r in decontam.contamination(docs, bench).collect()}
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(decontam, "PIECE_WORDS", 5)
    assert {tuple(map(str, r)) for r in decontam.contamination(docs, bench).collect()} == whole
    left = decontam.drop_contaminated(docs, bench)
    bad = {r.doc_id for r in decontam.contamination(docs, bench).filter("contaminated").collect()}
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in docs.collect()} - bad
    assert sorted(map(str, decontam.drop_contaminated(awkward, bench).collect())) == sorted(map(str, awkward.collect()))


@pytest.mark.parametrize("n", [9, 10, 11, 300])
def test_positions(spark, n):
    text = " ".join(f"w{i}" for i in range(n))
    docs = spark.createDataFrame([(i, "pad " * i + text) for i in range(30)], "doc_id long, text string")
    bench = spark.createDataFrame([("x", text)], "item_id string, text string")
    got = decontam.contamination(docs, bench).collect()
    assert all(r.n_hit == n and r.n_words == n + r.doc_id for r in got)


def test_benchmark_ten_times_the_budget(spark, docs, awkward, monkeypatch):
    """Groups of tables one after the other: the same result, and never more
    than the budget (or one block) broadcast."""
    bench = spark.read.parquet(f"{SF0001}/benchmark.parquet")
    rows = [(r.item_id, r.text) for r in bench.collect()]
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 1000)
    monkeypatch.setattr(decontam, "SHIFT_BITS", 8)
    sizes = [r.size for r in decontam.compile_benchmark(bench, 10, "item_id", "text").collect()]
    budget = sum(sizes) // 10
    monkeypatch.setattr(decontam, "BUDGET_BYTES", budget)
    shipped = []
    own = decontam._box

    def box(compiled, blocks):
        b = own(compiled, blocks)
        shipped.append(sum(map(len, b.value)))
        return b

    monkeypatch.setattr(decontam, "_box", box)
    for table in (docs, awkward.withColumn("n_hit", decontam.F.lit("clash"))):
        shipped.clear()
        got = decontam.contamination(table, bench)
        have = sorted((r.doc_id, r.n_words, r.n_hit, len(r["items"]),
                       hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.contaminated) for r in got.collect())
        assert have == brute([(r.doc_id, r.text) for r in table.collect()], rows)
        assert len(shipped) >= 8 and max(shipped) <= max(budget, max(sizes))
        left = decontam.drop_contaminated(table, bench)
        assert left.columns == table.columns
        assert sorted(r.doc_id for r in left.collect()) == sorted(x[0] for x in have if not x[5])


def test_a_long_item_is_cut_into_pieces(spark, monkeypatch):
    monkeypatch.setattr(decontam, "PIECE_WORDS", 7)
    text = " ".join(f"w{i}" for i in range(60))
    bench = spark.createDataFrame([("x", text), ("y", "w3 w4"), ("z", None)], "item_id string, text string")
    docs = spark.createDataFrame([(0, text), (1, " ".join(text.split()[20:33])), (2, "w3 w4 w5"), (None, "w9")],
                                 "doc_id long, text string")
    got = {r.doc_id: (r.n_hit, r["items"]) for r in decontam.contamination(docs, bench).collect()}
    assert got == {0: (60, ["x", "y"]), 1: (13, ["x"]), 2: (2, ["y"]), None: (0, [])}
