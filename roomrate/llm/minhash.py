"""MinHash near-duplicates (operator 10) with a circulant signature.

Two permutations give the whole signature (C-MinHash): the first scatters
each shingle to a place in a universe of 2**32, the second, shifted by k
places, orders the universe for coordinate k, and the smallest value is the
coordinate. Both are bijections, so this is one initial permutation and one
circularly shifted one. ``BANDS`` bands of ``ROWS`` coordinates: a pair at
the threshold 0.8 misses every band with probability
(1 - 0.8**5)**38 < 3e-7, and pairs above it less; at a threshold of 0.85, 32
bands of 6 give the same.

1. One pass over the documents: number of shingles, a 128-bit key of the
   shingle set, the band keys. Documents with equal sets are one class from
   here on, so copies cost one row each however many there are.
2. Classes that share a band key are linked to the smallest of them (a star,
   never all pairs); components of the stars are clusters that hold every
   candidate pair.
3. Each cluster is verified on full shingle sets. Texts of members are read
   once (the rest of the corpus is not shuffled for them). A cluster is cut into
   chunks, each with the cluster's smallest member, the hub; every chunk is
   one group, which finds what its members share through an index of their
   shingles and returns only links that join something new. A cluster that this
   joins, as copies of one text are, is done: each text was shipped once.
4. In other clusters the members outside the largest group go to all chunks but
   their own, and are compared with what is there; the rest is shipped a
   second time and no more.
5. Components of the verified links; members get their class's component.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomrate.llm.common import (BROADCAST_ROWS, NOT_SPACE, Scratch, Words, free_worker_tables, lower_ascii, mix64,
                                 shingle_hashes, staged, string_slices, tidy)
from roomrate.llm.components import components

ROWS, BANDS = 5, 38
#: Sizes of a chunk of a cluster in verification: documents, shingles.
CHUNK_DOCS, CHUNK_SHINGLES = 512, 400_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _second_permutation(x: np.ndarray) -> np.ndarray:
    """A bijection of 32-bit integers (in place)."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def circulant_signature(shingles: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """Signatures (one row a set) of sets given one after another; no set is
    empty. ``shingles``: 64-bit hashes; ``starts``: where each set begins."""
    place = (mix64(shingles ^ _ODD) >> np.uint64(32)).astype(np.uint32)
    sig = np.empty((len(starts), k), np.uint32)
    buf = np.empty_like(place)
    for i in range(k):
        np.add(place, np.uint32(i), out=buf)
        sig[:, i] = np.minimum.reduceat(_second_permutation(buf), starts)
    return sig


def band_keys(sig: np.ndarray, rows: int, bands: int) -> np.ndarray:
    keys = np.empty((len(sig), bands), np.uint64)
    for b in range(bands):
        x = np.full(len(sig), b + 1, np.uint64)
        for i in range(rows):
            x = x * _ODD + sig[:, b * rows + i]
        keys[:, b] = mix64(x)
    return keys.view(np.int64)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, and their bounds."""
    words = Words(lower_ascii(raw), offsets, NOT_SPACE)
    h, bounds = shingle_hashes(words, k)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(len(bounds)))


def set_keys(h: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a = np.add.reduceat(mix64(h + _ODD), starts)
    b = np.bitwise_xor.reduceat(mix64(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts)
    return a.view(np.int64), b.view(np.int64)


def signatures(docs: DataFrame, shingle: int, rows: int, bands: int,
               id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, key_a, key_b, bands) per row; no bands for empty sets."""

    def run(batches):
        free_worker_tables()
        for batch in batches:
            for ids, raw, offsets in string_slices(batch.column(0), batch.column(1)):
                h, bounds = shingle_sets(raw, offsets, shingle)
                n = np.diff(bounds)
                some = n > 0
                starts = bounds[:-1][some]
                a, b = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
                keys = np.zeros((0, bands), np.int64)
                if some.any():
                    a[some], b[some] = set_keys(h, starts)
                    keys = band_keys(circulant_signature(h, starts, rows * bands), rows, bands)
                ends = np.concatenate([[0], np.cumsum(some) * bands]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n, pa.int64()), pa.array(a), pa.array(b),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel()))],
                    ["id", "n_shingles", "key_a", "key_b", "bands"])

    return docs.select(F.col(id_col).cast("long").alias("id"), text_col).mapInArrow(
        tidy(run), "id long, n_shingles long, key_a long, key_b long, bands array<long>")


def similar_links(sets: list[np.ndarray], groups: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links (i, j) that join the similar sets of ``sets`` into the same
    components as all similar pairs would. ``groups``: 0 or 1; pairs are
    compared across the two groups, or within if there is only one."""
    n = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    column = np.cumsum(new) - 1
    shared = np.bincount(column) > 1
    keep = shared[column]
    column, owner = (np.cumsum(shared) - 1)[column[keep]], owner[keep]
    inter = np.zeros((n, n), np.float32)
    step = 4096  # columns of the incidence matrix at a time
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        a, b = np.searchsorted(column, [lo, lo + step])
        m = np.zeros((n, step), np.float32)
        m[owner[a:b], column[a:b] - lo] = 1
        used = np.unique(owner[a:b])
        m = m[used]
        inter[np.ix_(used, used)] += m @ m.T
    inter = inter.astype(np.int64)
    similar = 100 * inter >= percent * (size[:, None] + size[None, :] - inter)
    if groups.any() and not groups.all():
        similar &= groups[:, None] != groups[None, :]
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []
    for i, j in zip(*np.nonzero(np.triu(similar, 1))):
        a, b = find(int(i)), find(int(j))
        if a != b:
            root[max(a, b)] = min(a, b)
            links.append((int(i), int(j)))
    return links


def _cuts(n_docs: str, n_shingles: str):
    """Chunks for so many documents and shingles."""
    return F.greatest(F.ceil(F.col(n_docs) / CHUNK_DOCS), F.ceil(F.col(n_shingles) / CHUNK_SHINGLES)).cast("int")


def _member_texts(classes: DataFrame, clusters: DataFrame, docs: DataFrame, id_col: str,
                  text_col: str, scratch: Scratch) -> DataFrame:
    """(component, cuts, chunk, node, n_shingles, key_a, key_b, text) of the
    members of clusters."""
    members = clusters.join(classes.select(F.col("rep").alias("node"), "n_shingles", "key_a", "key_b"), "node")
    sizes = (members.groupBy("component").agg(F.count(F.lit(1)).alias("d"), F.sum("n_shingles").alias("s"))
             .select("component", _cuts("d", "s").alias("cuts")))
    wanted = scratch.stage(members.join(sizes, "component").withColumn(
        "chunk", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int")), "members")
    few = wanted.count() <= BROADCAST_ROWS
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = texts.join(F.broadcast(wanted) if few else wanted, F.col("id") == F.col("node"))
    return scratch.stage(found.select("component", "cuts", "chunk", "node", "n_shingles", "key_a", "key_b", "text"),
                         "member-texts")


def _links(rows: DataFrame, keys: list[str], shingle: int, percent: int) -> DataFrame:
    """Exact links (u, v) between the classes of each group, those that join
    something new; of two sides, only links across them."""

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        free_worker_tables()
        pdf = pdf.sort_values(["side", "node"], kind="stable")
        texts = [t.encode() for t in pdf["text"].fillna("")]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        h, bounds = shingle_sets(np.frombuffer(b"".join(texts), np.uint8), offsets, shingle)
        # a row whose id repeats with another text is not this class
        a, b = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        some = np.diff(bounds) > 0
        a[some], b[some] = set_keys(h, bounds[:-1][some])
        own = (a == pdf["key_a"].to_numpy()) & (b == pdf["key_b"].to_numpy())
        own &= ~pdf.assign(own=own).duplicated(["node", "own"]).to_numpy()
        at = np.flatnonzero(own)
        nodes = pdf["node"].to_numpy()[at]
        if len(at) < 2:
            return pd.DataFrame({"u": [], "v": []}, dtype="int64")
        links = similar_links([h[bounds[x]:bounds[x + 1]] for x in at], pdf["side"].to_numpy()[at], percent)
        return pd.DataFrame({"u": [nodes[x] for x, _ in links], "v": [nodes[y] for _, y in links]},
                            dtype="int64")

    return (rows.select(*keys, "side", "node", "key_a", "key_b", "text").groupBy(*keys)
            .applyInPandas(verify, "u long, v long"))


def _verified(texts: DataFrame, shingle: int, percent: int, scratch: Scratch) -> DataFrame:
    """Links (u, v) that join the similar classes of each cluster."""
    inside = texts.withColumn("side", F.lit(0))
    hub = (F.col("cuts") > 1) & (F.col("node") == F.col("component"))
    inside = inside.filter(~hub).unionByName(
        inside.filter(hub).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))))
    first = scratch.stage(_links(inside, ["component", "chunk"], shingle, percent), "chunk-links")
    joined = scratch.own(components(first))
    # members outside the largest group of a cluster of several chunks
    grouped = (texts.filter("cuts > 1").select("component", "cuts", "chunk", "node", "n_shingles").distinct()
               .join(joined.select("node", F.col("component").alias("grp")), "node", "left")
               .withColumn("grp", F.coalesce("grp", "node")))
    main = (grouped.groupBy("component", "grp").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("component").agg(F.max_by("grp", F.struct("n", "grp")).alias("main")))
    outside = scratch.stage(grouped.join(main, "component").filter("grp <> main")
                            .select("component", "cuts", "chunk", "node", "n_shingles"), "outside")
    sizes = scratch.stage(
        outside.groupBy("component").agg(F.count(F.lit(1)).alias("d"), F.sum("n_shingles").alias("s"))
        .select("component", _cuts("d", "s").alias("parts")), "outside-sizes")
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    there = texts.join(sizes, "component").withColumn("part", F.explode(every)).withColumn("side", F.lit(0))
    come = (texts.join(outside.select("node"), "node", "left_semi").join(sizes, "component")
            .withColumn("part", F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).cast("int"))
            .withColumn("to", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))).filter("to <> chunk")
            .withColumn("chunk", F.col("to")).withColumn("side", F.lit(1)))
    columns = ["component", "chunk", "part", "side", "node", "key_a", "key_b", "text"]
    across = there.select(*columns).unionByName(come.select(*columns))
    return first.unionByName(_links(across, ["component", "chunk", "part"], shingle, percent))


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, rows: int = ROWS,
                    bands: int = BANDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``docs``.

    Two rows are linked if 100 * |A & B| >= percent * |A | B| on their sets of
    ``shingle``-word shingles (the whole sequence if there are fewer words);
    ``component_id`` is the smallest id reachable. Null and empty texts have
    no set and are linked with nothing. Rows that repeat an id are one
    document, with the links of all its texts. A null id names no document:
    such a row is linked with nothing, its ``component_id`` is null, and it is
    kept. Other columns are not read. Ids are integers.
    """
    with Scratch(docs.sparkSession) as scratch:
        sig = scratch.stage(signatures(docs, shingle, rows, bands, id_col, text_col), "signatures")
        keys = ["key_a", "key_b", "n_shingles"]
        classes = scratch.stage(sig.filter("n_shingles > 0 and id is not null").groupBy(*keys)
                                .agg(F.min("id").alias("rep"), F.any_value("bands").alias("bands")), "classes")
        banded = classes.select("rep", F.explode("bands").alias("band"))
        hubs = (banded.groupBy("band").agg(F.min("rep").alias("hub"), F.max("rep").alias("top"))
                .filter("hub < top").select("band", "hub"))
        stars = (banded.join(hubs, "band").filter("rep <> hub")
                 .select(F.col("hub").alias("u"), F.col("rep").alias("v")))
        clusters = scratch.own(components(stars))
        texts = _member_texts(classes.drop("bands"), clusters, docs, id_col, text_col, scratch)
        found = scratch.own(components(_verified(texts, shingle, percent, scratch))).withColumnRenamed("node", "rep")
        of_class = (classes.drop("bands").join(found, "rep", "left")
                    .select(*keys, F.coalesce("component", "rep").alias("component_id")))
        out = sig.drop("bands").join(of_class, keys, "left").withColumn(
            "component_id", F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")))
        return staged(out.select(
            F.col("id").alias(id_col), "n_shingles", "component_id",
            F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept")), "near-duplicates")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         **parameters) -> DataFrame:
    """The rows of ``docs`` that are the first of their group, columns as they
    were. Rows whose id is null stay."""
    with Scratch(docs.sparkSession) as scratch:
        found = scratch.own(near_duplicates(docs, id_col=id_col, text_col=text_col, **parameters))
        gone = staged(found.filter(~F.col("kept")).select(F.col(id_col).alias("_gone")).distinct(), "gone")
    few = gone.count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(gone) if few else gone, docs[id_col].cast("long") == gone["_gone"], "left_anti")
