"""Toxicity by non-negative positive-unlabelled learning (operator 7).

Only confirmed toxic documents count as examples; all other training
documents are unlabelled, toxic ones among them. With class prior p the risk
of a classifier is p * R+(positives) + max(0, R-(unlabelled) - p * R-(positives)):
the part of the unlabelled risk that the hidden positives cause is taken off,
and the rest is held at or above 0 (Kiryo et al., 2017). The classifier is
a logistic model over the presence of words and word stems. Its features come
from all training documents: words, and their stems of ``STEMS`` bytes, are
hashed (64 bits) after ASCII lower-casing; tasks tally how many confirmed and
unlabelled documents hold each, and the ``MAX_WORDS`` whose share among
positives differs most surely from that expected of negatives (the
prior-corrected share of unlabelled documents) become features. Only the
weights are fitted on a sample, in numpy on the driver: at most
``MAX_POSITIVE`` and ``MAX_UNLABELLED`` documents, those of the smallest hashed
ids. Every document is scored, from its whole text alone.

Defined results: null and empty texts have no words and get the score of the
bias. Without positives or without unlabelled documents every score is
the prior. Ids and all columns but the text are not inputs of a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomrate.llm.common import ALNUM, BROADCAST_ROWS, Words, free_worker_tables, lower_ascii, staged, string_slices, tidy

MAX_POSITIVE, MAX_UNLABELLED = 2_000, 8_000
#: Lengths of the stems (beginnings of longer words), in bytes.
STEMS = (3, 4, 5, 6, 7, 8)
MAX_WORDS = 1_000
#: A word has to be in this many training documents, and a share this many
#: standard errors from what the other class explains, to be a feature.
MIN_DOCS, MIN_Z = 3, 3.0
#: Distinct words that a task tallies before it passes them on.
TALLY = 1 << 20
EPOCHS, RATE, L2 = 600, 0.05, 1e-3
DEFAULT_PRIOR = 0.1


@dataclass
class Model:
    words: np.ndarray    # sorted word hashes
    weights: np.ndarray
    bias: float

    def scores(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        doc, feature = present(raw, offsets, self.words)
        z = self.bias + np.bincount(doc, self.weights[feature], minlength=len(offsets) - 1)
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def _hashes(raw: np.ndarray, offsets: np.ndarray):
    """(document, hash) of every word and stem, an array pair at a time."""
    words = Words(lower_ascii(raw), offsets, ALNUM)
    if not len(words):
        return
    doc = words.doc_of_word()
    yield doc, words.hash
    lens = words.end - words.start
    for n in STEMS:
        longer = lens > n
        yield doc[longer], words.stems(n, longer)


def present(raw: np.ndarray, offsets: np.ndarray, vocabulary: np.ndarray) -> tuple:
    """Distinct (document, feature) pairs of a slice."""
    pairs = []
    if len(vocabulary):
        for doc, h in _hashes(raw, offsets):
            i = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
            known = np.flatnonzero(vocabulary[i] == h)
            pairs.append(doc[known] * len(vocabulary) + i[known])
    if not pairs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pair = np.unique(np.concatenate(pairs))
    return pair // len(vocabulary), pair % len(vocabulary)


def _marked(docs: DataFrame, toxic: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, positive, text) of all rows; texts are shuffled only if there are
    more confirmed ids than a broadcast may hold."""
    ids = toxic.select(F.col(id_col).alias("_toxic"))
    if ids.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    found = docs.join(ids, F.col(id_col) == F.col("_toxic"), "left")
    return found.select(F.col(id_col).alias("id"), F.col("_toxic").isNotNull().alias("positive"),
                        F.col(text_col).alias("text"))


def _sample(marked: DataFrame) -> DataFrame:
    """(positive, text) of the sampled documents. Ids are drawn first, so that
    only they are shuffled, and the few drawn are broadcast to the texts."""
    ids = marked.select("id", "positive").distinct()
    order = [F.xxhash64(F.col("id").cast("string"), F.lit(7)), F.col("id")]
    drawn = (ids.filter("positive").orderBy(*order).limit(MAX_POSITIVE)
             .unionByName(ids.filter("not positive").orderBy(*order).limit(MAX_UNLABELLED)))
    drawn = staged(drawn.select(F.col("id").alias("drawn")), "toxicity-drawn")
    found = marked.join(F.broadcast(drawn), F.col("id") == F.col("drawn"))
    return staged(found.select("positive", "text"), "toxicity-sample")


def word_counts(marked: DataFrame) -> DataFrame:
    """(word, pos, unl): how many documents of either kind hold the word."""

    def merged(parts):
        h, pos, total = (np.concatenate(x) for x in zip(*parts))
        u, at = np.unique(h, return_inverse=True)
        return u, np.bincount(at, pos).astype(np.int64), np.bincount(at, total).astype(np.int64)

    def rows(tally):
        u, pos, total = tally
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(pos), pa.array(total - pos)],
                                          ["word", "pos", "unl"])

    def run(batches):
        free_worker_tables()
        parts: list[tuple] = []
        for b in batches:
            for kinds, raw, offsets in string_slices(b.column(0), b.column(1)):
                kind = np.array(kinds.to_pylist(), bool)
                found = list(_hashes(raw, offsets))
                if not found:
                    continue
                d, h = (np.concatenate(x) for x in zip(*found))
                order = np.lexsort((d, h))
                h, d = h[order], d[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
                u, at = np.unique(h[new], return_inverse=True)
                parts.append((u, np.bincount(at, kind[d[new]], minlength=len(u)).astype(np.int64),
                              np.bincount(at, minlength=len(u)).astype(np.int64)))
                if len(parts) > 16:
                    parts = [merged(parts)]
                    if len(parts[0][0]) > TALLY:
                        yield rows(parts.pop())
        if parts:
            yield rows(merged(parts))

    return (marked.select("positive", "text").mapInArrow(tidy(run), "word long, pos long, unl long")
            .groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("unl").alias("unl")))


def _features(counts: DataFrame, n_pos: int, n_unl: int, prior: float) -> np.ndarray:
    p, u = F.col("pos") / n_pos, F.col("unl") / n_unl
    negative = F.greatest(F.lit(0.0), (u - prior * p) / (1 - prior))
    error = F.sqrt((p * (1 - p) + F.lit(1.0 / n_pos)) / n_pos + (u * (1 - u) + F.lit(1.0 / n_unl)) / n_unl)
    z = F.abs(p - negative) / error
    top = (counts.filter(F.col("pos") + F.col("unl") >= MIN_DOCS).withColumn("z", z)
           .filter(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "word").limit(MAX_WORDS))
    words = np.array([r.word for r in top.select("word").collect()], np.int64).view(np.uint64)
    return np.sort(words)


def _matrix(sample: DataFrame, words: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Feature numbers of each sampled document, and whether it is positive."""
    box = sample.sparkSession.sparkContext.broadcast(words)

    def run(batches):
        for b in batches:
            for kinds, raw, offsets in string_slices(b.column(0), b.column(1)):
                doc, feature = present(raw, offsets, box.value)
                ends = np.searchsorted(doc, np.arange(len(offsets))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [kinds, pa.ListArray.from_arrays(pa.array(ends), pa.array(feature.astype(np.int16)))],
                    ["positive", "features"])

    got = sample.select("positive", "text").mapInArrow(
        tidy(run), "positive boolean, features array<short>").toArrow()
    lists = got.column("features").combine_chunks()
    ends = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False).astype(np.int64)
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])], got.column("positive").to_numpy().astype(bool)


def train_nnpu(x: np.ndarray, positive: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias of the logistic model of the smallest
    non-negative PU risk (Adam, full batches; where the negative part of the
    risk falls below 0 a step raises it instead)."""
    xp, xu = x[positive], x[~positive]
    w = np.zeros(x.shape[1] + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)

    def gradient(part: np.ndarray, target: float) -> tuple[float, np.ndarray]:
        z = part @ w[:-1] + w[-1]
        s = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        loss = np.mean(np.logaddexp(0, -z if target else z))
        r = (s - target) / len(part)
        return loss, np.append(r @ part, r.sum())

    for step in range(1, EPOCHS + 1):
        _, gp = gradient(xp, 1.0)
        lp, gpn = gradient(xp, 0.0)
        lu, gun = gradient(xu, 0.0)
        if lu - prior * lp >= 0:
            g = prior * gp + gun - prior * gpn
        else:
            g = prior * gpn - gun
        g[:-1] += L2 * w[:-1]
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, is_train: Column, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic") -> Model:
    """Model from the training documents; the class prior is the share of
    toxic rows among labelled training documents. A null id is never
    confirmed toxic."""
    labels = labels.filter(is_train & F.col(label_col).isNotNull())
    share = labels.agg(F.avg(F.col(label_col).cast("double"))).first()[0]
    if share is None:
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(DEFAULT_PRIOR / (1 - DEFAULT_PRIOR))))
    prior = min(max(float(share), 1e-3), 0.9)
    nothing = Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(prior / (1 - prior))))
    toxic = labels.filter(F.col(label_col) == 1).select(id_col).distinct()
    marked = _marked(docs.filter(is_train), toxic, id_col, text_col)
    n = {r[0]: r[1] for r in marked.groupBy("positive").count().collect()}
    if not n.get(True) or not n.get(False):
        return nothing
    words = _features(word_counts(marked), n[True], n[False], prior)
    if not len(words):
        return nothing
    lists, positive = _matrix(_sample(marked), words)
    x = np.zeros((len(lists), len(words)), np.float32)
    for i, f in enumerate(lists):
        x[i, f] = 1
    weights, bias = train_nnpu(x, positive, prior)
    return Model(words, weights, bias)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) of every row."""
    box = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        free_worker_tables()
        for b in batches:
            for ids, raw, offsets in string_slices(b.column(0), b.column(1)):
                s = box.value.scores(raw, offsets)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                    [id_col, "score", "predicted"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(tidy(run), f"`{id_col}` {kind}, score double, predicted int")
