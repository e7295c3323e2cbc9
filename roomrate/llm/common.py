"""Shared helpers: table loading, staged tables, and vectorised word
splitting over Arrow string buffers.

Text columns reach Python as Arrow batches. A batch is cut into slices of
about ``SLICE_BYTES`` so that working arrays stay small however long the
batch is; one document is never cut, so a slice is at most one document
larger than that.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from roomrate.session import checkpoint_root, scratch_path

SLICE_BYTES = 1 << 20
#: Largest table of a few integers a row that is broadcast after its rows are
#: counted; a larger one is joined by shuffle.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Has Spark delete the shuffle files of a query when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_freed(spark: SparkSession):
    """For queries whose result is written: their shuffle files go when they
    end, not when the driver happens to collect its garbage."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def staged(df: DataFrame, name: str, rows_a_file: int = 0) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder named by
    ``spark.checkpoint.dir`` and read it back: cuts the lineage, survives the
    loss of executors. Shuffle files of the write do not outlast it. At most
    ``rows_a_file`` rows a file (0: any number), for rows so large that those
    of a file must not be read at once."""
    spark = df.sparkSession
    checkpoint_root(spark)
    path = scratch_path(spark, name)
    with _shuffles_freed(spark):
        df.write.option("maxRecordsPerFile", rows_a_file).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.staged_at = path
    return table


def delete_staged(table: DataFrame) -> None:
    """Delete the files of a table that ``staged`` returned. Nothing may read
    it any more."""
    spark = table.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.staged_at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


class Scratch:
    """Owns the staged tables of one computation: each is deleted after its
    last reader (``drop``), the rest when the ``with`` block ends, whether it
    succeeds or not. What the block returns must be staged outside of it."""

    def __init__(self, spark: SparkSession):
        self.spark, self.tables = spark, []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error) -> None:
        self.drop(*self.tables)

    def own(self, table: DataFrame) -> DataFrame:
        """Take over a table that another function staged."""
        self.tables.append(table)
        return table

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        return self.own(staged(df, name))

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            delete_staged(t)
        self.tables = [t for t in self.tables if all(t is not x for x in tables)]


_WORKER_TABLES: dict = {}


def worker_table(key: tuple, make):
    """What ``make`` returns, kept in this Python worker from task to task
    under ``key``. A worker is used by one operator after the other and holds
    one such table at a time, so that tables do not add up."""
    if key not in _WORKER_TABLES:
        _WORKER_TABLES.clear()
        _WORKER_TABLES[key] = make()
    return _WORKER_TABLES[key]


def free_worker_tables() -> None:
    """For tasks that keep none: let go of what operators before have kept."""
    _WORKER_TABLES.clear()


def give_back() -> None:
    """Return memory that this worker has freed to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run):
    """``run``, a task over Arrow batches, that gives its memory back at its
    end: workers stay, idle, beside the stages that follow."""

    def whole(batches):
        yield from run(batches)
        give_back()

    return whole


def string_slices(ids: pa.Array, texts: pa.Array,
                  max_bytes: int = SLICE_BYTES) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Cut (ids, texts) into slices of about ``max_bytes`` of text.

    Yields the slice's ids, its UTF-8 bytes as ``uint8`` and the offsets of
    its texts in them (one more than texts). Null texts count as empty.
    """
    if pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    _, off_buf, data = texts.buffers()
    offsets = np.frombuffer(off_buf, dtype=np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    start = 0
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + max_bytes, side="right")) - 1
        end = min(max(end, start + 1), n)
        yield (ids.slice(start, end - start), raw[offsets[start]:offsets[end]],
               offsets[start:end + 1] - offsets[start])
        start = end


def byte_class(word_bytes: bytes | None = None, not_in: bytes | None = None) -> np.ndarray:
    """Boolean table over byte values: bytes of words."""
    t = np.zeros(256, bool)
    if word_bytes is not None:
        t[list(word_bytes)] = True
    else:
        t[:] = True
        t[list(not_in)] = False
    return t


#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z: ASCII
#: digits and letters and every byte of a non-ASCII character.
ALNUM = byte_class(b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)))
#: Words ``[^\x20\x09-\x0D]+``: everything but ASCII white space.
NOT_SPACE = byte_class(not_in=b" \t\n\x0b\x0c\r")

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    """Lower-case A-Z, leave every other byte."""
    return _LOWER[buf]


_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULT = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (in place)."""
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        p = np.full(max(n, 256), _MULT, np.uint64)
        p[0] = 1
        _POWERS = np.multiply.accumulate(p)
    return _POWERS


class Words:
    """Words of a slice: ``start``/``end`` byte positions, the index of each
    word's document, 64-bit hashes, and the words' bounds per document."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, classes: np.ndarray):
        m = classes[buf]
        first = np.zeros(len(buf) + 1, bool)
        first[offsets] = True  # a word never runs on into the next document
        prev = np.empty_like(m)
        prev[:1] = False
        prev[1:] = m[:-1]
        begins = m & (~prev | first[:-1])
        self.start = np.flatnonzero(begins)
        inside = buf[m]
        at = np.cumsum(m, dtype=np.int64)[self.start] - 1 if len(self.start) else np.zeros(0, np.int64)
        lens = np.diff(np.append(at, len(inside)))
        self.end = self.start + lens
        #: words of document i are bounds[i]:bounds[i + 1]
        self.bounds = np.searchsorted(self.start, offsets)
        self._at = at
        if len(at):
            pos = np.arange(len(inside)) - np.repeat(at, lens)
            self._terms = _BYTE_VALUE[inside] * _powers(int(lens.max()))[pos]
            self.hash = mix64(np.add.reduceat(self._terms, at))
        else:
            self._terms = self.hash = np.zeros(0, np.uint64)

    def stems(self, n: int, which: np.ndarray) -> np.ndarray:
        """Hashes of the first ``n`` bytes of the words of ``which``, all of
        which have more. A stem never equals a whole word's hash."""
        at = self._at[which]
        x = np.full(len(at), 0x5851F42D4C957F2D, np.uint64)
        for j in range(n):
            x += self._terms[at + j]
        return mix64(x)

    def __len__(self) -> int:
        return len(self.start)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def shingle_hashes(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``k``-word shingles, document by document, and their
    bounds per document. A document with some words but fewer than ``k`` has
    its whole sequence as its one shingle; one without words has none."""
    n_words = np.diff(words.bounds)
    n_sh = np.where(n_words >= k, n_words - k + 1, (n_words > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(n_sh)])
    total = int(bounds[-1])
    first_word = np.repeat(words.bounds[:-1] - bounds[:-1], n_sh) + np.arange(total)
    width = np.repeat(np.minimum(n_words, k), n_sh)
    h = width.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    padded = np.concatenate([words.hash, np.zeros(k, np.uint64)])
    for j in range(k):
        term = padded[first_word + j]
        if (n_words < k).any():
            term = np.where(width > j, term, np.uint64(0))
        h = h * _MULT + term
    return mix64(h), bounds
