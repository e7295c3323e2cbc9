"""Token counts of fields and sections by offset mapping (operator 2).

A document is encoded once, whole (with a run longer than ``RUN`` of spaces or
of anything else, by the transducer of operator 3, which gives the same tokens
for runs of any length; the library's encoder, a few times as fast, does not
survive them), so its tokens are those that a model would
see, and not those of its sections encoded apart. Token lengths in bytes give
each token's span; together with the bytes that begin a character they give
spans in code points. Sections are intervals of code points; both lists are
sorted, so the interval join of tokens and sections is a merge (two binary
searches of all boundaries at once) inside the document's row: tokens are
never exploded.

A token that crosses a boundary goes by ``rule``:
- ``start``: to the section that holds its first character (the character
  that its first byte belongs to);
- ``majority``: to the section that holds more than half of its bytes, or its
  first half (to none, if there is no such section);
- ``fraction``: to each section, the share of its bytes.
Tokens, or bytes of them, outside every section count nowhere. With ``start``
and ``majority`` every section's count is a whole number.

Defined results: null and empty texts have no tokens; a section that is empty
or outside the text has none; sections of one document may overlap or nest,
and each counts on its own. Rows keep their multiplicity; other columns are
not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomrate.llm.bpe import Encoder, parse_ranks
from roomrate.llm.common import worker_table

RULES = ("start", "majority", "fraction")
#: Longest run that the library's encoder is given.
RUN = 1000


class TokenLengths:
    """Byte lengths of the tokens of a text."""

    def __init__(self, ranks_file: bytes, pattern: str):
        import tiktoken

        self.ranks, self.pattern = parse_ranks(ranks_file), pattern
        self.fast = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})
        self.any_run: Encoder | None = None
        self.long_run = re.compile(rf"\s{{{RUN}}}|\S{{{RUN}}}")
        self.size = np.zeros(max(self.ranks.values()) + 1, np.int64)
        self.size[list(self.ranks.values())] = [len(t) for t in self.ranks]

    def __call__(self, text: str) -> np.ndarray:
        if not self.long_run.search(text):
            ids = self.fast.encode_ordinary(text)
        else:
            self.any_run = self.any_run or Encoder(self.ranks, self.pattern)
            ids = self.any_run.encode(text)
        return self.size[np.array(ids, np.int64)]


def char_to_byte(data: np.ndarray) -> np.ndarray:
    """Byte position of every code point, and of the end."""
    return np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))


def allocate(token_ends: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str,
             data: np.ndarray | None = None) -> np.ndarray:
    """Tokens of each byte interval [starts, ends), by ``rule``. Token i spans
    token_ends[i - 1]:token_ends[i]."""
    n = len(token_ends)
    if not n or not len(starts):
        return np.zeros(len(starts))
    bounds = np.concatenate([[0], token_ends])
    lens = np.diff(bounds)
    if rule == "start":
        first = bounds[:-1]
        if data is not None:  # a token may begin inside a character
            at = char_to_byte(data)
            first = at[np.searchsorted(at, first, "right") - 1]
        return (np.searchsorted(first, ends, "left") - np.searchsorted(first, starts, "left")).clip(0).astype(float)
    # tokens up to a byte position, the last one in part
    def upto(p):
        i = np.minimum(np.searchsorted(token_ends, p, "right"), n - 1)
        return i + np.clip((p - bounds[i]) / lens[i], 0, 1)

    total = np.maximum(upto(ends) - upto(starts), 0)
    if rule == "fraction":
        return total
    out = np.zeros(len(starts))
    for s, (lo, hi) in enumerate(zip(starts.tolist(), ends.tolist())):
        i = int(np.searchsorted(token_ends, lo, "right"))  # first token with a byte in it
        j = int(np.searchsorted(bounds[:-1], hi, "left"))  # one after the last
        if hi <= lo or j <= i:
            continue
        out[s] = j - i
        for t in {i, j - 1}:  # only these can cross a boundary
            a, b = int(bounds[t]), int(bounds[t + 1])
            own = 2 * (min(b, hi) - max(a, lo))
            if own < b - a or own == b - a and a < lo:
                out[s] -= 1
    return out


def _line_sections(text: str) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum([len(x) + 1 for x in text.split("\n")])
    ends[-1] -= 1
    return np.concatenate([[0], ends[:-1]]), ends


def _run(box, pattern: str, rule: str, id_col: str, with_sections: bool):
    def one(lengths, text, sections):
        data = np.frombuffer(text.encode(), np.uint8)
        token_ends = np.cumsum(lengths(text))
        if with_sections:
            sections = [s for s in (sections or []) if s is not None]
            start = np.array([s["start"] or 0 for s in sections], np.int64)
            end = np.array([s["end"] if s["end"] is not None else len(text) for s in sections], np.int64)
            names = [s["name"] for s in sections]
        else:
            start, end = _line_sections(text)
            names = [str(i) for i in range(len(start))]
        at = char_to_byte(data)
        n_chars = len(at) - 1
        start, end = np.clip(start, 0, n_chars), np.clip(end, 0, n_chars)
        lo, hi = at[start], np.maximum(at[end], at[start])
        return names, start, end, allocate(token_ends, lo, hi, rule, data), len(token_ends)

    def run(batches):
        lengths = worker_table(("section-tokens", hashlib.sha256(box.value).digest(), pattern),
                               lambda: TokenLengths(box.value, pattern))
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                rows = [one(lengths, t.as_py() or "", part.column(2)[i].as_py() if with_sections else None)
                        for i, t in enumerate(part.column(1))]
                n = np.array([len(r[0]) for r in rows])
                take = pa.array(np.repeat(np.arange(len(rows)), n))
                cat = lambda i, kind: np.concatenate([r[i] for r in rows]).astype(kind)
                order = np.concatenate([np.arange(k) for k in n]) if len(n) else np.zeros(0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), pa.array(order.astype(np.int32)),
                     pa.array([x for r in rows for x in r[0]], pa.string()),
                     pa.array(cat(1, np.int32)), pa.array(cat(2, np.int32)), pa.array(cat(3, np.float64)),
                     pa.array(np.repeat([r[4] for r in rows], n).astype(np.int64))],
                    [id_col, "section_no", "section", "start", "end", "n_tokens", "doc_tokens"])

    return run


def section_tokens(docs: DataFrame, ranks_path: str, sections: DataFrame | None = None, rule: str = "start",
                   pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, section_no, section, start, end, n_tokens, doc_tokens): one row per
    document and section, in the order of the sections.

    ``sections``: (id, section, start, end) intervals of code points (nulls:
    start or end of the text); they are gathered per document and joined by
    id, a document without any has no rows. Without ``sections`` they are the
    document's lines, each with the line break that ends it, so that they
    cover the text.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}, not {rule!r}")
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    with open(ranks_path, "rb") as f:
        box = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = dict(docs.dtypes)[id_col]
    own = docs.select(id_col, text_col)
    if sections is not None:
        spans = (sections.groupBy(F.col(id_col).alias("_id"))
                 .agg(F.array_sort(F.collect_list(F.struct(
                     F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"),
                     F.col("section").cast("string").alias("name")))).alias("_sections")))
        own = own.join(spans, F.col(id_col) == F.col("_id")).select(id_col, text_col, "_sections")
    return own.mapInArrow(
        _run(box, pattern, rule, id_col, sections is not None),
        f"`{id_col}` {kind}, section_no int, section string, start int, end int, n_tokens double, doc_tokens long")
