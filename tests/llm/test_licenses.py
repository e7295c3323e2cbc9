"""Licence scan against brute force (operator 4)."""

import random
import re

from conftest import SF001
from llm_fixtures import awkward, docs, nothing  # noqa: F401
from roomrate.llm import licenses
from roomrate.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_every_exact_line_is_found(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    got = {r.doc_id: r.matches for r in QUERIES["op4_license_scan"](spark, SF001).collect()}
    lines = {n: words(t) for n, t in licenses.TEMPLATES.items() if n.endswith("-line")}
    seen = 0
    for r in df.collect():
        w = words(r.text)
        want = {(n, i) for n, t in lines.items() for i in range(len(w) - len(t) + 1) if w[i:i + len(t)] == t}
        have = {(m.split(":")[0], int(m.split(":")[1])) for m in got[r.doc_id].split(",") if m}
        assert want <= have
        assert not have or want  # nothing in clean documents
        seen += len(want)
    assert seen > 5 and len(got) == df.count()


def test_edited_copies_at_any_place(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for i, (name, text) in enumerate(sorted(licenses.TEMPLATES.items()) * 6):
        body = words(text)
        if len(body) > 25:  # one word changed: at most 5 shingles of 21 or more
            body[rng.randrange(len(body))] = "changed"
        before, after = rng.randrange(200), rng.randrange(200)
        rows.append((i, " ".join([f"b{j}" for j in range(before)] + body + [f"a{j}" for j in range(after)])))
        want[i] = (name, before, before + len(body))
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for r in got:
        name, a, b = want[r.doc_id]
        near = [m for m in r.matches if m.template == name]
        assert near, (name, a)
        assert a <= near[0].first_word and near[0].end_word <= b


def test_containment_is_exact(spark):
    t = {"x": " ".join(f"t{j}" for j in range(44))}  # 40 shingles
    rows = []
    for cut in range(20):  # the first words missing: 40 - cut shingles left
        rows.append((cut, " ".join([f"z{j}" for j in range(50)] + [f"t{j}" for j in range(cut, 44)])))
    got = {r.doc_id: r.matches for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), t).collect()}
    for cut, m in got.items():
        assert bool(m) == ((40 - cut) / 40 >= 0.8)
        if m:
            assert abs(m[0].containment - (40 - cut) / 40) < 1e-9


def test_awkward(awkward, nothing):
    assert all(r.matches == [] for r in licenses.scan(awkward).collect())
    assert licenses.scan(awkward).count() == awkward.count()
    assert licenses.scan(nothing).count() == 0
    some = {r.doc_id: r.matches for r in licenses.scan(awkward, {"a": "Eleven, twelve", "none": "!!"}).collect()}
    assert [m.first_word for m in some[11]] == [10, 22, 34]
