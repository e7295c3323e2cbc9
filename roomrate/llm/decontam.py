"""Benchmark decontamination (operator 8): Wu-Manber search for many word
windows at once.

Benchmark items and documents are cut into words (ASCII letters
lower-cased). Every ``window`` consecutive words of an item are one pattern;
an item with fewer words is one pattern as a whole. The search reads
documents from left to right by blocks of two words: a shift table tells how
far the end of any pattern must be away, so most positions are never looked
at; where the shift is zero, the bucket of the block's hash selects the
patterns that end in it, and the words themselves are compared before a hit
counts.

No benchmark is too large. Its items are cut into pieces of ``PIECE_WORDS``
windows, dealt to blocks of about ``BLOCK_BYTES`` of text and compiled by tasks,
a block each, into search tables that are written to the shared folder. The
search takes as many tables at a time as fit in ``BUDGET_BYTES``: only these
are broadcast, and the documents are read once for each such group. With one
group that is all; with more, each group's hits are written, and a document's
are united by its id and text.

Defined results: null texts have no words; items without words have no
pattern; repeated items and windows count once per item id; an item whose id
is null marks words but is not listed. Documents that repeat an id and text
have the same hits.
"""

from __future__ import annotations

import pickle
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomrate.llm.common import ALNUM, Scratch, Words, lower_ascii, mix64, staged, string_slices, tidy, worker_table

#: Text of a block, compiled tables that are searched at once, and windows of a piece.
BLOCK_BYTES, BUDGET_BYTES, PIECE_WORDS = 1 << 20, 64 << 20, 4096
SHIFT_BITS = 18
#: End positions that one lane of the search walks through.
LANE = 256
_M = np.uint64(0x9E3779B97F4A7C15)


def _block_hash(h: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words that end at each position."""
    x = h[at].copy()
    if size > 1:
        x += h[at - 1] * _M
    return mix64(x)


def _window_hash(h: np.ndarray, ends: np.ndarray, m: int) -> np.ndarray:
    x = np.zeros(len(ends), np.uint64)
    for j in range(m):
        x = x * _M + h[ends - m + 1 + j]
    return mix64(x)


class Patterns:
    """Patterns of one length: shift table, suffix buckets, windows."""

    def __init__(self, m: int, words: dict[bytes, list[str]]):
        self.m, self.size = m, min(2, m)
        self.texts = list(words)
        self.items = [words[t] for t in self.texts]
        h = np.concatenate([_words(t).hash for t in self.texts])
        ends = np.arange(1, len(self.texts) + 1) * m - 1
        self.shift = np.full(1 << SHIFT_BITS, min(m - self.size + 1, 255), np.uint8)
        for j in range(self.size, m + 1):  # blocks further left first: smaller shifts win
            cell = _block_hash(h, ends - (m - j), self.size) >> np.uint64(64 - SHIFT_BITS)
            np.minimum.at(self.shift, cell.astype(np.int64), min(m - j, 255))
        self.suffixes = np.unique(_block_hash(h, ends, self.size))
        w = _window_hash(h, ends, m)
        self.order = np.argsort(w, kind="stable")
        self.windows = w[self.order]

    def find(self, text: Words, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word position of the window's end, pattern) of every occurrence."""
        h, m = text.hash, self.m
        first, stop = text.bounds[:-1] + m - 1, text.bounds[1:]
        n_lanes = np.maximum(0, -(-(stop - first) // LANE))
        lane = np.arange(n_lanes.sum()) - np.repeat(np.cumsum(n_lanes) - n_lanes, n_lanes)
        pos = np.repeat(first, n_lanes) + lane * LANE
        stop = np.minimum(pos + LANE, np.repeat(stop, n_lanes))
        found = []
        while len(pos):
            block = _block_hash(h, pos, self.size)
            shift = self.shift[(block >> np.uint64(64 - SHIFT_BITS)).astype(np.int64)]
            zero = shift == 0
            if zero.any():
                at, b = pos[zero], block[zero]
                i = np.minimum(np.searchsorted(self.suffixes, b), len(self.suffixes) - 1)
                found.append(at[self.suffixes[i] == b])
            pos = pos + np.maximum(shift, 1)
            keep = pos < stop
            pos, stop = pos[keep], stop[keep]
        ends = np.concatenate(found) if found else np.zeros(0, np.int64)
        w = _window_hash(h, ends, m)
        hits, which = [], []
        lo, hi = np.searchsorted(self.windows, w, "left"), np.searchsorted(self.windows, w, "right")
        for e, a, b in zip(ends[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
            here = _text_of(text, low, e - m + 1, e + 1)
            for p in self.order[a:b].tolist():
                if self.texts[p] == here:
                    hits.append(e)
                    which.append(p)
        return np.array(hits, np.int64), np.array(which, np.int64)


def _words(text: bytes) -> Words:
    buf = lower_ascii(np.frombuffer(text, np.uint8))
    return Words(buf, np.array([0, len(buf)]), ALNUM)


def _text_of(words: Words, low: np.ndarray, i: int, j: int) -> bytes:
    return b" ".join([low[s:e].tobytes() for s, e in zip(words.start[i:j].tolist(),
                                                         words.end[i:j].tolist())])


def compile_patterns(items: list[tuple[str | None, bytes]], window: int) -> list[Patterns]:
    """One search table for each pattern length that occurs in the words
    (lower-cased, single spaces between them) of (item, words)."""
    by_length: dict[int, dict[bytes, set]] = defaultdict(lambda: defaultdict(set))
    for item, text in items:
        words = bytes(text).split(b" ")
        m = min(len(words), window)
        for i in range(len(words) - m + 1):
            by_length[m][b" ".join(words[i:i + m])].add(item)
    return [Patterns(m, {t: sorted(x for x in ids if x is not None) for t, ids in texts.items()})
            for m, texts in sorted(by_length.items())]


def _pieces(benchmark: DataFrame, window: int, item_col: str, text_col: str) -> DataFrame:
    """(item, piece): the words of the items, long items in pieces that share
    ``window`` - 1 words, so that each window is in one of them."""

    def run(batches):
        for b in batches:
            for ids, raw, offsets in string_slices(b.column(0), b.column(1)):
                low = lower_ascii(raw)
                words = Words(low, offsets, ALNUM)
                items, pieces = [], []
                for d, (lo, hi) in enumerate(zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist())):
                    for at in range(lo, max(hi - window + 1, lo + 1) if hi > lo else lo, PIECE_WORDS):
                        items.append(d)
                        pieces.append(_text_of(words, low, at, min(at + PIECE_WORDS + window - 1, hi)))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(items, pa.int64())), pa.array(pieces, pa.binary())], ["item", "piece"])

    return (benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
            .mapInArrow(tidy(run), "item string, piece binary"))


def compile_benchmark(benchmark: DataFrame, window: int, item_col: str, text_col: str) -> DataFrame:
    """(block, tables, size): pickled search tables of each block."""
    pieces = _pieces(benchmark, window, item_col, text_col)
    total = pieces.agg(F.sum(F.octet_length("piece"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))

    def compiled(pdf: pd.DataFrame) -> pd.DataFrame:
        tables = pickle.dumps(compile_patterns(list(zip(pdf["item"], pdf["piece"])), window))
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "tables": [tables], "size": [len(tables)]})

    block = F.pmod(F.xxhash64("item", "piece"), F.lit(blocks))
    return (pieces.withColumn("block", block).groupBy("block")
            .applyInPandas(compiled, "block long, tables binary, size long"))


def _grouped(sizes: list[tuple[int, int]]) -> list[list[int]]:
    """Blocks (block, size) in groups of at most ``BUDGET_BYTES``, or of one."""
    groups: list[list[int]] = []
    room = 0
    for block, size in sorted(sizes):
        if not groups or size > room:
            groups.append([])
            room = BUDGET_BYTES
        groups[-1].append(block)
        room -= size
    return groups or [[]]


def _box(compiled: DataFrame, blocks: list[int]):
    """Broadcast of the tables of some blocks."""
    rows = compiled.filter(F.col("block").isin(blocks)).select("tables").collect()
    return compiled.sparkSession.sparkContext.broadcast([bytes(r.tables) for r in rows])


def _loaded(box) -> list[Patterns]:
    """The tables of a broadcast; a worker holds those of one at a time."""
    return worker_table(("benchmark", id(box.value)), lambda: (
        box.value, [p for t in box.value for p in pickle.loads(t)]))[1]


def _scan_slice(low: np.ndarray, offsets: np.ndarray, tables: list[Patterns]) -> tuple:
    """Words of the texts, which of them are hit, items with hits per text."""
    words = Words(low, offsets, ALNUM)
    edge = np.zeros(len(words) + 1, np.int64)
    items: list[set] = [set() for _ in range(len(offsets) - 1)]
    for patterns in tables:
        ends, which = patterns.find(words, low)
        np.add.at(edge, ends - patterns.m + 1, 1)
        np.add.at(edge, ends + 1, -1)
        docs = np.searchsorted(words.bounds, ends, "right") - 1
        for d, p in set(zip(docs.tolist(), which.tolist())):
            items[d].update(patterns.items[p])
    return words, np.cumsum(edge)[:-1] > 0, items


def _count(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(mask)])[bounds])


def _schema(docs: DataFrame, id_col: str) -> str:
    return (f"`{id_col}` {dict(docs.dtypes)[id_col]}, n_words long, n_hit long, items array<string>, "
            "contaminated boolean")


def _search(docs: DataFrame, box, id_col: str, text_col: str) -> DataFrame:
    """The result for the tables of one broadcast."""

    def run(batches):
        tables = _loaded(box)
        for b in batches:
            for ids, raw, offsets in string_slices(b.column(0), b.column(1)):
                words, mask, items = _scan_slice(lower_ascii(raw), offsets, tables)
                hit = _count(mask, words.bounds)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.diff(words.bounds), pa.int64()), pa.array(hit, pa.int64()),
                     pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                     pa.array(hit > 0, pa.bool_())],
                    [id_col, "n_words", "n_hit", "items", "contaminated"])

    return docs.select(id_col, text_col).mapInArrow(tidy(run), _schema(docs, id_col))


def _hits(docs: DataFrame, box, id_col: str, text_col: str) -> DataFrame:
    """(id, key, hits, items) of the distinct (id, text) with hits: runs of
    words hit as (start, end)."""

    def run(batches):
        tables = _loaded(box)
        for b in batches:
            at = 0
            for ids, raw, offsets in string_slices(b.column(0), b.column(2)):
                words, mask, items = _scan_slice(lower_ascii(raw), offsets, tables)
                hit = np.flatnonzero(_count(mask, words.bounds) > 0)
                runs = []
                for d in hit.tolist():
                    own = np.diff(mask[words.bounds[d]:words.bounds[d + 1]].astype(np.int8), prepend=0, append=0)
                    runs.append([{"start": int(x), "end": int(y)} for x, y in zip(
                        np.flatnonzero(own == 1), np.flatnonzero(own == -1))])
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(hit)), b.column(1).slice(at, len(ids)).take(pa.array(hit)),
                     pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                     pa.array([sorted(items[d]) for d in hit.tolist()], pa.list_(pa.string()))],
                    ["id", "key", "hits", "items"])
                at += len(ids)

    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    return keyed.mapInArrow(tidy(run), f"id {dict(docs.dtypes)[id_col]}, key long, "
                                 "hits array<struct<start:long,end:long>>, items array<string>"
                            ).dropDuplicates(["id", "key"])


def _united(hits: DataFrame) -> DataFrame:
    """(id, key, n_hit, items) from the hits of all groups of tables."""
    runs = F.array_sort(F.flatten(F.collect_list("hits")))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    n = F.aggregate(runs, start, lambda acc, r: F.struct(
        (acc["n"] + F.greatest(r["end"] - F.greatest(r["start"], acc["upto"]), F.lit(0).cast("long"))).alias("n"),
        F.greatest(acc["upto"], r["end"]).alias("upto")))["n"]
    return hits.groupBy("id", "key").agg(
        n.alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10,
                  id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, n_words, n_hit, items array<string> sorted, contaminated) of every
    document; other columns are not read. One row per input row."""
    with Scratch(docs.sparkSession) as scratch:
        compiled = scratch.stage(compile_benchmark(benchmark, window, item_col, item_text_col), "benchmark-tables")
        groups = _grouped([tuple(r) for r in compiled.select("block", "size").collect()])
        if len(groups) == 1:
            return _search(docs, _box(compiled, groups[0]), id_col, text_col)
        found = []
        for g in groups:
            box = _box(compiled, g)
            found.append(scratch.stage(_hits(docs, box, id_col, text_col), "benchmark-hits"))
            box.destroy()
        every = found[0]
        for f in found[1:]:
            every = every.unionByName(f)
        hits = staged(_united(every).withColumnsRenamed({"id": "_id", "key": "_key"}), "contamination")
    counted = _word_counts(docs.select(id_col, F.xxhash64(text_col).alias("key"), text_col), id_col, text_col)
    out = counted.join(hits, (F.col("key") == F.col("_key")) & F.col(id_col).eqNullSafe(F.col("_id")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(id_col, "n_words", n_hit.alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      (n_hit > 0).alias("contaminated"))


def _word_counts(keyed: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, n_words) of every row of (id, key, text)."""

    def run(batches):
        for b in batches:
            at = 0
            for ids, raw, offsets in string_slices(b.column(0), b.column(2)):
                n = np.diff(Words(lower_ascii(raw), offsets, ALNUM).bounds)
                yield pa.RecordBatch.from_arrays(
                    [ids, b.column(1).slice(at, len(ids)), pa.array(n, pa.int64())], [id_col, "key", "n_words"])
                at += len(ids)

    return keyed.mapInArrow(tidy(run), f"`{id_col}` {dict(keyed.dtypes)[id_col]}, key long, n_words long")


def _clean(docs: DataFrame, box, text_col: str) -> DataFrame:
    """The rows without a hit in the tables of one broadcast. The whole row
    travels through the search: a row is judged by its own text and nothing is
    joined."""
    at = docs.columns.index(text_col)

    def run(batches):
        tables = _loaded(box)
        for b in batches:
            clean = []
            for _, raw, offsets in string_slices(b.column(at), b.column(at)):
                words, mask, _ = _scan_slice(lower_ascii(raw), offsets, tables)
                clean.append(_count(mask, words.bounds) == 0)
            if clean:
                yield b.filter(pa.array(np.concatenate(clean)))

    return docs.mapInArrow(tidy(run), docs.schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without any benchmark window, columns as they were.
    With several groups of tables each takes what the one before left."""
    with Scratch(docs.sparkSession) as scratch:
        compiled = scratch.stage(compile_benchmark(benchmark, window, "item_id", "text"), "benchmark-tables")
        groups = _grouped([tuple(r) for r in compiled.select("block", "size").collect()])
        for g in groups[:-1]:
            box = _box(compiled, g)
            before, docs = docs, scratch.stage(_clean(docs, box, text_col), "clean")
            box.destroy()
            if any(before is t for t in scratch.tables):
                scratch.drop(before)
        left = _clean(docs, _box(compiled, groups[-1]), text_col)
        return staged(left, "clean") if len(groups) > 1 else left
