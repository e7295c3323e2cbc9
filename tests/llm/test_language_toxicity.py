"""Language and toxicity models: held-out accuracy, awkward rows (operators 7, 9)."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from llm_fixtures import awkward, docs, nothing  # noqa: F401
from roomrate.llm import langid, toxicity
from roomrate.llm.common import ALNUM, Words
from roomrate.llm.queries import QUERIES


def test_language_held_out(spark):
    got = QUERIES["op9_language"](spark, SF001)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = got.collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    out = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in out]) > 0.98
    assert np.mean([r.rejected for r in rows]) < 0.005
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_awkward(spark, docs, awkward, nothing):
    model = langid.fit(docs, F.lit(True))
    rows = {r.doc_id: r for r in langid.predict(awkward, model).collect()}
    for i in (1, 2, 3, 9):
        assert (rows[i].lang_pred, rows[i].score, rows[i].rejected) == ("und", 0.0, True)
    assert rows[5].lang_pred in model.languages
    assert langid.predict(nothing, model).count() == 0
    kept = langid.drop_rejected(awkward, model)
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(
        r.doc_id for r in langid.predict(awkward, model).filter("not rejected").collect())
    none = langid.fit(nothing, F.lit(True))
    assert none is None
    assert all(r.lang_pred == "und" for r in langid.predict(awkward, none).collect())
    other = spark.createDataFrame([(1, "Привет как дела сегодня " * 20), (2, "xqzk wvxj qqzx " * 30)],
                                  "doc_id long, text string")
    assert langid.drop_rejected(other, model).count() == 0


def test_language_left_out_and_junk_among_scripts(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "lang", "text")
    model = langid.fit(docs.filter("lang <> 'fr'"), F.lit(True))
    share = {r.lang: r.kept for r in docs.join(langid.predict(docs, model), "doc_id").groupBy("lang").agg(
        F.avg((~F.col("rejected")).cast("int")).alias("kept")).collect()}
    print(share)
    assert share["fr"] < 0.1
    assert min(share[x] for x in ("de", "en", "es")) > 0.97
    rng = np.random.default_rng(6)
    scripts = {"ru": "абвгдежзийклмнопрст", "zh": "的一是不了人我在有他这中大来上国", "ja": "のにはをたがでてとしれさ"}
    rows = [(10**6 + 100 * j + i, lang, " ".join("".join(rng.choice(list(s), 5)) for _ in range(150)))
            for j, (lang, s) in enumerate(scripts.items()) for i in range(60)]
    many = docs.filter("lang = 'en'").union(spark.createDataFrame(rows, docs.schema))
    model = langid.fit(many, F.lit(True))
    other = docs.filter("lang <> 'en'").union(spark.createDataFrame(
        [(1, "", "xqzk wvxj qqzx " * 30)], docs.schema))
    kept = langid.drop_rejected(other, model).count() / other.count()
    print(kept)
    assert kept < 0.1
    assert langid.drop_rejected(many, model).count() > 0.97 * many.count()


def test_language_counts_are_whole(docs):
    rows = docs.limit(30).collect()
    some = docs.filter(F.col("doc_id").isin([r.doc_id for r in rows]))
    want = {}
    for r in rows:
        s = " " + "".join(c if c.isalpha() else " " for c in r.text.lower()) + " "
        s = " ".join(["", *s.split(), ""]) if not r.text.lower()[-1:].isalpha() else " " + " ".join(s.split()) + " "
        n = len(s) - 2
        want[r.lang] = want.get(r.lang, 0) + n
    got = {r[0]: r[1] for r in langid.count_ngrams(some, 3, "lang", "text").groupBy("lang")
           .agg(F.sum("n")).collect()}
    for lang, n in want.items():
        assert abs(got[lang] - n) <= 2 * len(rows)


def symbols(text):
    out = [" "]
    for c in text.lower():
        if c.isalpha():
            out.append(c)
        elif out[-1] != " ":
            out.append(" ")
    return out + [" "]  # the break after the text


def trigrams(text):
    s = symbols(text)
    return [tuple(s[i:i + 3]) for i in range(len(s) - 2)] if any(c != " " for c in s) else []


class Direct:
    """Interpolated Kneser-Ney written from its definition, on tuples."""

    def __init__(self, texts, alphabet):
        self.n = [None, {}, {}, {}]
        for t in texts:
            for g in trigrams(t):
                self.n[3][g] = self.n[3].get(g, 0) + 1
        for k in (2, 1):  # continuation counts
            for g in self.n[k + 1]:
                self.n[k][g[1:]] = self.n[k].get(g[1:], 0) + 1
        self.alphabet = alphabet

    def p(self, g):
        if not g:
            return 1 / self.alphabet
        own = {x: n for x, n in self.n[len(g)].items() if x[:-1] == g[:-1]}
        if not own:
            return self.p(g[1:])
        total = sum(own.values())
        return max(own.get(g, 0) - langid.DISCOUNT, 0) / total + langid.DISCOUNT * len(own) / total * self.p(g[1:])


def test_scores_equal_a_direct_model(spark):
    """Cross-entropies of the sorted arrays against the definition; letters of
    several scripts, of them some beyond 16 bits."""
    texts = {"aa": ["The cat sat. The dog sat!", "a cat, a dog"], "bb": ["Der Hund saß; straße", "die Straße 12"],
             "zz": ["猫坐在垫子上", "狗坐在𠀀𠀁上 猫"]}
    rows = [(i, lang, t) for i, (lang, t) in enumerate((lang, t) for lang, ts in texts.items() for t in ts)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = langid.fit(docs, F.lit(True))
    last = {g[-1] for ts in texts.values() for t in ts for g in trigrams(t)}
    direct = [Direct(texts[x], len(last) + 1) for x in model.languages]
    asked = [*(t for _, _, t in rows), "the straße", "猫 the 𠀀", "qqq", "Ωμέγα", "x"]
    raw = [t.encode() for t in asked]
    n, h = model.cross_entropy(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    for i, t in enumerate(asked):
        grams = trigrams(t)
        assert n[i] == len(grams)
        for j, d in enumerate(direct):
            assert h[i, j] == pytest.approx(-np.mean([np.log(d.p(g)) for g in grams]), rel=1e-5)
    best = {r.doc_id: r.lang_pred for r in langid.predict(docs, model).collect()}
    assert best == {i: lang for i, lang, _ in rows}


def test_a_task_passes_on_what_it_counted(spark, docs, monkeypatch):
    whole = {tuple(r) for r in langid.count_ngrams(docs, 3, "lang", "text").collect()}
    monkeypatch.setattr(langid, "TALLY", 10)
    assert {tuple(r) for r in langid.count_ngrams(docs, 3, "lang", "text").collect()} == whole


def test_a_model_beyond_its_bound_is_an_error(docs, monkeypatch):
    monkeypatch.setattr(langid, "MODEL_BYTES", 1000)
    with pytest.raises(ValueError, match="MODEL_BYTES"):
        langid.fit(docs, F.lit(True))


def test_toxicity_held_out(spark):
    got = QUERIES["op7_toxicity"](spark, SF001)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    rows = got.collect()
    assert len(rows) == spark.read.parquet(f"{SF001}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    known = [(r.score, toxic[r.doc_id]) for r in rows if r.doc_id in toxic]
    pos, neg = [s for s, y in known if y], [s for s, y in known if not y]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc > 0.85


def test_toxicity_ignores_labels_of_the_held_out_fold(spark, docs):
    labels = spark.createDataFrame([(r.doc_id, r.doc_id % 3 == 0) for r in docs.collect()], "doc_id long, toxic boolean")
    labels = labels.withColumn("toxic", F.col("toxic").cast("int"))
    out = langid.held_out("doc_id", 5, 0)
    a = toxicity.fit(docs, labels, ~out)
    b = toxicity.fit(docs, labels.withColumn("toxic", F.when(out, 1 - F.col("toxic")).otherwise(F.col("toxic"))), ~out)
    assert np.array_equal(a.words, b.words) and np.array_equal(a.weights, b.weights)


def one_hash(word, stem=None):
    raw = np.frombuffer(word, np.uint8)
    w = Words(raw, np.array([0, len(raw)]), ALNUM)
    return int(w.hash[0]) if stem is None else int(w.stems(stem, np.array([True]))[0])


def test_scores_equal_a_direct_computation(spark):
    """Each score from the set of a text's words and stems."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF001}/labels.parquet"), F.lit(True))
    weight = dict(zip(model.words.tolist(), model.weights))
    assert len(weight) >= 5
    for r in toxicity.score(docs, model).join(docs.select("doc_id", "text"), "doc_id").collect():
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text)
        words = {w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)}
        seen = {one_hash(w) for w in words} | {one_hash(w, n) for w in words for n in toxicity.STEMS if len(w) > n}
        z = model.bias + sum(weight.get(h, 0.0) for h in seen)
        assert r.score == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9)


def test_words_are_counted_over_all_documents(spark, monkeypatch):
    """Confirmed documents beyond the sample count: their word becomes a
    feature though no sampled document holds it."""
    monkeypatch.setattr(toxicity, "MAX_POSITIVE", 10)
    monkeypatch.setattr(toxicity, "MAX_UNLABELLED", 40)
    monkeypatch.setattr(toxicity, "TALLY", 20)
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choice(base, 12)) + (" vile" if i < 100 else "")) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 100)) for i in range(200)], "doc_id long, toxic int")
    drawn = docs.filter("doc_id < 100").orderBy(F.xxhash64(F.col("doc_id").cast("string"), F.lit(7)), "doc_id").limit(10)
    inside = {r.doc_id for r in drawn.collect()}
    docs = docs.withColumn("text", F.when(F.col("doc_id").isin(inside), F.regexp_replace("text", " vile", "")).otherwise(F.col("text")))
    model = toxicity.fit(docs, labels, F.lit(True))
    assert one_hash(b"vile") in model.words.tolist()
    counts = {r.word: (r.pos, r.unl) for r in toxicity.word_counts(
        toxicity._marked(docs, labels.filter("toxic = 1"), "doc_id", "text")).collect()}
    assert counts[np.uint64(one_hash(b"vile")).view(np.int64)] == (90, 0)


def test_nnpu_finds_the_signal_behind_unlabelled_positives():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.3
    x = (rng.random((4000, 20)) < 0.05).astype(np.float32)
    x[y, 0] = 1
    labelled = y & (rng.random(4000) < 0.3)
    w, b = toxicity.train_nnpu(x, labelled, 0.23)
    s = x @ w + b
    assert w.argmax() == 0
    assert np.mean((s > 0)[y & ~labelled]) > 0.9


def test_toxicity_awkward(spark, docs, awkward, nothing):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = toxicity.fit(docs, labels, F.lit(True))
    rows = {r.doc_id: r.score for r in toxicity.score(awkward, model).collect()}
    assert rows[1] == rows[2] == rows[3] == rows[9]
    assert toxicity.score(nothing, model).count() == 0
    none = toxicity.fit(docs, labels.limit(0), F.lit(True))
    assert {round(r.score, 6) for r in toxicity.score(awkward, none).collect()} == {0.1}
    odd = labels.limit(3).withColumn("toxic", F.lit(None).cast("int"))
    assert toxicity.score(awkward, toxicity.fit(awkward, odd, F.lit(True))).count() == awkward.count()
