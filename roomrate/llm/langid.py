"""Language identification (operator 9): interpolated Kneser-Ney character
models, one per language.

Text is lower-cased; every run of characters that are not letters is one
space. A symbol is 16 bits wide: a letter's code point, letters beyond the
first 65,536 code points hashed to as many, so an n-gram of order 3 is a 48-bit
code. Counts of all training documents, continuation counts, probabilities and
the weights of contexts are DataFrames grouped by (language, code) and
(language, context). Each language's come out as packed sorted arrays, and only
these reach the driver, which lines them up in one sorted array of n-gram
hashes with a column for each language, for tasks to search. A model grows
with the n-grams that languages have, not with the corpus; above
``MODEL_BYTES`` it is an error, as no part of it may be left out.

Interpolated Kneser-Ney: P(c | ab) = (n(abc) - D)/n(ab.) + D * t(ab)/n(ab.) * P(c | b),
with continuation counts for the lower orders and a uniform floor.

The prediction is the language of the lowest cross-entropy per character.
Rejection is calibrated on all training documents: a text is in no learned
language if its best model fits it worse than that language's own texts of
its length (their 0.99 quantile and as much again as this is above the
median), or no better than it fits texts of the closest other language
(median), if that is above the quantile.

Defined results: null texts and texts without a letter are ``und``, rejected,
score 0. Ties go to the language that sorts first. With nothing to learn from,
every text is ``und``. Other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomrate.llm.common import Scratch, free_worker_tables, string_slices, tidy

ORDER = 3
BITS = 16
SPACE = 32
#: Distinct n-grams that a task counts before it passes them on, and the
#: largest model.
TALLY, MODEL_BYTES = 1 << 20, 1 << 29
DISCOUNT = 0.75
#: Share of a language's own training documents at or below its high quantile,
#: and the room above it, in distances of that quantile from the median.
QUANTILE, ROOM = 0.99, 1.0
#: Lengths (powers of two) with fewer documents have no quantiles of their own.
SIZE_DOCS, SIZES = 200, 32
#: Characters in a prediction's favour that count at most for its score.
SCORE_CHARS = 50
UND = "und"

_CLASS: np.ndarray | None = None


def _char_classes() -> np.ndarray:
    """Code point -> 16-bit symbol; 0 for what is not a letter."""
    global _CLASS
    if _CLASS is None:
        points = np.arange(0x110000, dtype=np.uint32)
        letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
        hashed = (points * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
        cls = np.where(points < 1 << BITS, points, np.maximum(hashed, SPACE + 1))
        _CLASS = np.where(letter, cls, 0).astype(np.uint16)
    return _CLASS


def _symbols(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the texts of a slice: each text is a space, its letters with
    single spaces for everything between them, and a space; a text without a
    letter has none. Returns symbols and bounds per text."""
    data = raw.tobytes()
    texts = [data[a:b].decode("utf-8", "replace").lower()
             for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    points = np.frombuffer("\n".join(["", *texts, ""]).encode("utf-32-le", "replace"), np.uint32)
    sym = _char_classes()[points]
    space = sym == 0
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]  # the first of each run of spaces
    lens = np.array([len(t) + 1 for t in texts], np.int64)
    begin = np.concatenate([[0], np.cumsum(lens)])  # position of each text's leading break
    keep[begin] = True
    sym = np.where(space, np.uint16(SPACE), sym)
    before = np.concatenate([[0], np.cumsum(keep)])
    return sym[keep], before[begin]


def _ngrams(sym: np.ndarray, bounds: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all n-grams inside each text and their bounds per text. The
    n-grams of a text begin with its leading space and may end with the break
    that follows it."""
    if len(sym) < order:
        return np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    s = sym.astype(np.int64)
    n = len(s) - order + 1
    code = np.zeros(n, np.int64)
    for j in range(order):
        code = (code << BITS) | s[j:j + n]
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:n]
    last = np.minimum(bounds[1:], len(s) - 1)  # the break after the text
    ok = np.arange(n) + order - 1 <= last[text]
    has = np.add.reduceat(s[:-1] != SPACE, bounds[:-1]) > 0 if len(bounds) > 1 else np.zeros(0, bool)
    ok &= has[text]
    return code[ok], np.searchsorted(text[ok], np.arange(len(bounds)))


def _distinct(codes: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and, for each code, its place among them. A slice uses
    few symbols, so codes are renumbered densely rather than sorted."""
    present = np.zeros(1 << BITS, bool)
    parts = [(codes >> (BITS * j)) & ((1 << BITS) - 1) for j in range(order)]
    for x in parts:
        present[x] = True
    symbols = np.flatnonzero(present)
    base = len(symbols)
    if base ** order > 1 << 22:
        return np.unique(codes, return_inverse=True)
    number = np.cumsum(present) - 1
    dense = np.zeros(len(codes), np.int64)
    for x in reversed(parts):
        dense *= base
        dense += number[x]
    used = np.zeros(base ** order, bool)
    used[dense] = True
    seen = np.flatnonzero(used)
    back, rest = np.zeros(len(seen), np.int64), seen
    for j in range(order):
        back |= symbols[rest % base] << (BITS * j)
        rest = rest // base
    return back, (np.cumsum(used) - 1)[dense]


def count_ngrams(docs: DataFrame, order: int, lang_col: str, text_col: str) -> DataFrame:
    """(lang, code, n): n-gram counts of all rows, by language."""

    def run(batches):
        free_worker_tables()
        tally: dict[str, list] = {}

        def rows(lang):
            codes, n = tally.pop(lang)[0]
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes), pa.string()), pa.array(codes, pa.int64()),
                 pa.array(n, pa.int64())], ["lang", "code", "n"])

        def flush(lang):
            codes = np.concatenate([c for c, _ in tally[lang]])
            n = np.concatenate([k for _, k in tally[lang]])
            codes, at = np.unique(codes, return_inverse=True)
            tally[lang] = [(codes, np.bincount(at, n).astype(np.int64))]

        for b in batches:
            for langs, raw, offsets in string_slices(b.column(0), b.column(1)):
                codes, bounds = _ngrams(*_symbols(raw, offsets), order)
                of = np.array(langs.to_pylist(), dtype=object)
                of_code = np.repeat(of, np.diff(bounds))
                for lang in set(of):
                    seen, at = _distinct(codes[of_code == lang], order)
                    tally.setdefault(lang, []).append((seen, np.bincount(at, minlength=len(seen))))
                    if len(tally[lang]) > 64:
                        flush(lang)
                        if len(tally[lang][0][0]) > TALLY:
                            yield rows(lang)
        for lang in list(tally):
            flush(lang)
            yield rows(lang)

    return (docs.select(F.col(lang_col).cast("string").alias("lang"), text_col)
            .mapInArrow(tidy(run), "lang string, code long, n long")
            .groupBy("lang", "code").agg(F.sum("n").alias("n")))


def kneser_ney(counts: DataFrame, order: int, scratch: Scratch) -> list[tuple[DataFrame, DataFrame]]:
    """Per order 1..n: (lang, code, p), interpolated probabilities, and (lang,
    ctx, weight), what each context gives to the order below. ``counts``:
    (lang, code, n) of the highest order."""
    tables = [counts]
    for k in range(order, 1, -1):  # continuation counts: distinct k-grams that end in each (k-1)-gram
        ends = F.col("code").bitwiseAND(F.lit((1 << (BITS * (k - 1))) - 1))
        tables.insert(0, scratch.stage(tables[0].groupBy("lang", ends.alias("code"))
                                       .agg(F.count(F.lit(1)).alias("n")), "continuations"))
    symbols = tables[0].select(F.count_distinct("code")).first()[0] + 1
    out, below = [], None
    for k, t in enumerate(tables, 1):
        t = t.withColumn("ctx", F.shiftright("code", BITS))
        ctx = scratch.stage(t.groupBy("lang", "ctx").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("types"))
                            .withColumn("weight", DISCOUNT * F.col("types") / F.col("total")), "contexts")
        t = t.join(ctx, ["lang", "ctx"])
        if below is None:
            t = t.withColumn("low", F.lit(1.0 / symbols))
        else:
            t = (t.withColumn("ends", F.col("code").bitwiseAND(F.lit((1 << (BITS * (k - 1))) - 1)))
                 .join(below.select("lang", F.col("code").alias("ends"), F.col("p").alias("low")), ["lang", "ends"]))
        p = (F.col("n") - DISCOUNT) / F.col("total") + F.col("weight") * F.col("low")
        below = scratch.stage(t.select("lang", "code", p.alias("p")), "probabilities")
        out.append((below, ctx.select("lang", "ctx", "weight")))
    return out


def _packed(table: DataFrame, key: str, value: str) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Each language's codes, sorted, and their logarithms: one packed row a
    language reaches the driver."""
    rows = (table.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct(key, value))).alias("own"))
            .select("lang", F.col(f"own.{key}").alias("keys"), F.col(f"own.{value}").alias("values")).toArrow())
    return {lang.as_py(): (keys.values.to_numpy(), np.log(values.values.to_numpy()).astype(np.float32))
            for lang, keys, values in zip(*(rows.column(c) for c in ("lang", "keys", "values")))}


@dataclass
class Limit:
    """Cross-entropies that a language's own texts have, by language and
    length, and those that its model gives to the closest other language."""

    median: np.ndarray   # (language, size)
    spread: np.ndarray   # (language, size): from the median to the high quantile
    least: np.ndarray    # (language, size): n-grams from which that spread holds
    closest: np.ndarray  # per language

    def of(self, j: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Highest cross-entropy of texts of ``n`` n-grams in languages ``j``."""
        size = np.minimum(np.log2(np.maximum(n, 1)).astype(np.int64), SIZES - 1)
        # shorter texts than any that were learned from spread more
        spread = self.spread[j, size] * np.sqrt(np.maximum(self.least[j, size] / np.maximum(n, 1), 1.0))
        high = self.median[j, size] + spread
        return np.minimum(high + ROOM * spread, np.maximum(high, self.closest[j]))


@dataclass
class Model:
    """Sorted n-gram hashes (codes) and log-probabilities by language."""

    order: int
    languages: list[str]
    codes: list[np.ndarray]        # per order: sorted codes of any language
    logp: list[np.ndarray]         # per order: (code, language); nan if unseen there
    ctx: list[np.ndarray]          # per order: sorted contexts
    log_weight: list[np.ndarray]   # per order: (context, language); 0 if unseen
    floor: float                   # log-probability of a symbol never seen
    limit: Limit | None = None

    def _level(self, codes: np.ndarray, k: int) -> np.ndarray:
        n_lang = len(self.languages)
        if k == 0:
            return np.full((len(codes), n_lang), self.floor)
        table, logp = self.codes[k - 1], self.logp[k - 1]
        i = np.minimum(np.searchsorted(table, codes), len(table) - 1)
        out = np.where((table[i] == codes)[:, None], logp[i], np.nan).astype(np.float64)
        miss = np.isnan(out)
        rows = np.flatnonzero(miss.any(axis=1))
        if len(rows):
            rest = codes[rows]
            u, at = np.unique(rest, return_inverse=True)
            low = self._level(u & ((1 << (BITS * (k - 1))) - 1), k - 1)
            c, w = self.ctx[k - 1], self.log_weight[k - 1]
            j = np.minimum(np.searchsorted(c, u >> BITS), len(c) - 1)
            low = low + np.where((c[j] == (u >> BITS))[:, None], w[j], 0.0)
            out[rows] = np.where(miss[rows], low[at], out[rows])
        return out

    def cross_entropy(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per text: n-grams, and nats per n-gram by language."""
        codes, bounds = _ngrams(*_symbols(raw, offsets), self.order)
        n = np.diff(bounds)
        total = np.zeros((len(n), len(self.languages)))
        if len(codes):
            some = n > 0
            seen, at = _distinct(codes, self.order)
            logp = self._level(seen, self.order)
            for j in range(len(self.languages)):
                total[some, j] = np.add.reduceat(logp[:, j][at], bounds[:-1][some])
        return n, -total / np.maximum(n, 1)[:, None]


def _aligned(own: dict, languages: list[str], missing: float) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codes of any language, and a column of logarithms for each."""
    codes = np.unique(np.concatenate([k for k, _ in own.values()]))
    logs = np.full((len(codes), len(languages)), missing, np.float32)
    for j, lang in enumerate(languages):
        keys, values = own[lang]
        logs[np.searchsorted(codes, keys), j] = values
    return codes, logs


def _assemble(counts: DataFrame, order: int) -> Model | None:
    """Model from the counts (lang, code, n) of all training documents."""
    with Scratch(counts.sparkSession) as scratch:
        counts = scratch.stage(counts, "ngrams")
        sizes = {r[0]: r[1] for r in counts.groupBy("lang").count().collect()}  # a row per language
        languages = sorted(sizes)
        if not languages:
            return None
        # a column for each language, four bytes each, for codes of any of them
        if 4 * len(languages) * sum(sizes.values()) > MODEL_BYTES:
            raise ValueError(f"{sum(sizes.values())} n-grams of {len(languages)} languages exceed MODEL_BYTES")
        levels = kneser_ney(counts, order, scratch)
        symbols = levels[0][0].select(F.count_distinct("code")).first()[0] + 1
        m = Model(order, languages, [], [], [], [], -float(np.log(symbols)))
        for table, contexts in levels:
            for own, missing, to in ((_packed(table, "code", "p"), np.nan, (m.codes, m.logp)),
                                      (_packed(contexts, "ctx", "weight"), 0.0, (m.ctx, m.log_weight))):
                codes, logs = _aligned(own, languages, missing)
                to[0].append(codes)
                to[1].append(logs)
    return m


def _calibrate(model: Model, train: DataFrame, lang_col: str, text_col: str) -> None:
    """``model.limit`` from the cross-entropies of all training documents,
    aggregated by language and length (powers of two)."""
    box = train.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        free_worker_tables()
        m = box.value
        for b in batches:
            for langs, raw, offsets in string_slices(b.column(0), b.column(1)):
                n, h = m.cross_entropy(raw, offsets)
                yield pa.RecordBatch.from_arrays(
                    [langs, pa.array(n, pa.int64()), pa.array(list(h), pa.list_(pa.float64()))],
                    ["lang", "n", "h"])

    number = F.create_map(*[x for j, lang in enumerate(model.languages) for x in (F.lit(lang), F.lit(j))])
    with Scratch(train.sparkSession) as scratch:
        fits = scratch.stage(train.select(F.col(lang_col).cast("string").alias("lang"), text_col)
                      .mapInArrow(tidy(run), "lang string, n long, h array<double>").filter("n > 0")
                      .withColumn("j", number[F.col("lang")])
                      .withColumn("size", F.floor(F.log2("n")).cast("int")), "language-fits")
        own = F.percentile_approx(F.get("h", F.col("j")), [0.5, QUANTILE], 10_000).alias("q")
        some = F.count(F.lit(1)).alias("docs")
        med, high, least = (np.zeros((len(model.languages), SIZES)) for _ in range(3))
        closest = np.full(len(model.languages), -model.floor)
        whole = fits.groupBy("j").agg(own, F.percentile_approx("n", 0.5).alias("n"), F.array(*[
            F.percentile_approx(F.get("h", F.lit(j)), 0.5) for j in range(len(model.languages))]).alias("others"))
        for r in whole.collect():  # a row per language
            med[r.j], high[r.j], least[r.j] = r.q[0], r.q[1], r.n
            other = np.arange(len(closest)) != r.j
            closest[other] = np.minimum(closest[other], np.array(r.others)[other])
        sizes = fits.groupBy("j", "size").agg(own, some).filter(F.col("docs") >= SIZE_DOCS).collect()
        first = {}
        for r in sorted(sizes, key=lambda r: (r.j, r["size"])):
            # a size with few documents has the values of the one below it, or of the first
            lo = 0 if r.j not in first else r["size"]
            first[r.j] = True
            med[r.j, lo:], high[r.j, lo:], least[r.j, lo:] = r.q[0], r.q[1], 2.0 ** r["size"]
    model.limit = Limit(med, high - med, least, closest)


def fit(docs: DataFrame, is_train: Column, order: int = ORDER, lang_col: str = "lang",
        text_col: str = "text") -> Model | None:
    """Model from all rows that ``is_train`` and that name their language."""
    train = docs.filter(is_train & F.col(lang_col).isNotNull())
    model = _assemble(count_ngrams(train, order, lang_col, text_col), order)
    if model is not None:
        _calibrate(model, train, lang_col, text_col)
    return model


def _predict_slice(model: Model | None, raw: np.ndarray, offsets: np.ndarray) -> tuple:
    n_docs = len(offsets) - 1
    if model is None:
        return [UND] * n_docs, np.zeros(n_docs), np.full(n_docs, np.nan), np.ones(n_docs, bool)
    n, h = model.cross_entropy(raw, offsets)
    best = h.argmin(axis=1)
    low = h[np.arange(n_docs), best]
    gain = np.exp(-(h - low[:, None]) * np.minimum(n, SCORE_CHARS)[:, None])
    score = np.where(n > 0, 1.0 / gain.sum(axis=1), 0.0)
    reject = (n == 0) | (low > model.limit.of(best, n))
    lang = [model.languages[i] if k else UND for i, k in zip(best.tolist(), n.tolist())]
    return lang, score, np.where(n > 0, low, np.nan), reject


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, cross_entropy, rejected) of every row, from the
    text alone."""
    box = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        free_worker_tables()
        for b in batches:
            for ids, raw, offsets in string_slices(b.column(0), b.column(1)):
                lang, score, h, reject = _predict_slice(box.value, raw, offsets)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(lang, pa.string()), pa.array(score), pa.array(h), pa.array(reject)],
                    [id_col, "lang_pred", "score", "cross_entropy", "rejected"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(
        tidy(run), f"`{id_col}` {kind}, lang_pred string, score double, cross_entropy double, rejected boolean")


def drop_rejected(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is in a learned language, columns as
    they were; a row is judged by its own text and nothing is joined."""
    box = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        free_worker_tables()
        for b in batches:
            keep = [~_predict_slice(box.value, raw, offsets)[3]
                    for _, raw, offsets in string_slices(b.column(at), b.column(at))]
            if keep:
                yield b.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(tidy(run), docs.schema)


def held_out(id_col: str, folds: int, fold: int) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(folds)) == fold
