"""Approximate nearest neighbours by learned partitions (operator 5).

Fitted on a bounded sample (``SAMPLE`` distinct vectors of the smallest hashed
ids): the sample's exact neighbour graph is cut into balanced parts (every
part within ``BALANCE`` of the mean size) that keep neighbours together, and a
small softmax classifier, the router, learns a vector's part. A large table has
a router under each part as well, fitted by tasks in the same way on a bounded
sample of the part, so that the number of parts grows with the vectors (one
for ``LEAF``, ``MAX_LEAVES`` at most: the routers' size is bounded). A part's
probability is the product along its path. Every vector is indexed, in its most
probable part; a query is routed to its ``probes`` most probable ones, whose
vectors are ranked by the exact inner product in double precision.

The number of probes is measured. With one level: a router is fitted on half of
the sample, and held-out vectors of the other half look for their ``NEAREST``
exact neighbours in it. With two: sampled vectors' exact neighbours among all
vectors are found in one pass, with the place of each neighbour's part in the
vector's order. The fewest probes that find ``RECALL`` of them count (with one
level no fewer than ``PROBES``). If that is more than one in ``SELECTIVE`` of
the parts, as for vectors without clusters, small parts only multiply queries,
and one level is used.

Equal vectors have equal scores, and ties go to smaller ids, so of each
distinct vector only the ``k`` + 1 smallest ids can be among any query's
nearest: copies beyond these are left out before the search without changing
a result, however many there are. Vectors of a part are cut into blocks of
``BLOCK``. They stay where they are: only queries are sent, once to each block
that they probe. A partition is sorted by block, its vectors first, and read as
a stream: a task holds one block and one batch of queries.

Defined results: vectors that are null, empty, zero or that hold null or
non-finite components take no part, and neither do those of another length
than most. Rows that repeat an id count once if their vectors are equal, and
apart if not. Fewer candidates than ``k``: all found.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from roomrate.llm.common import Scratch, free_worker_tables, staged

SAMPLE, NEIGHBOURS = 4096, 10
PART_SIZE, MAX_PARTS = 256, 16
BALANCE = 1.15
#: Fewest probes, however high their recall.
PROBES = 6
#: Recall asked for of the probes (0.9 with a margin), of so many neighbours,
#: measured on at most so many held-out vectors.
RECALL, NEAREST, HELD_OUT = 0.94, 20, 1024
#: Vectors of a part of the second level, parts at most, vectors from which
#: there is a second level, vectors that measure its recall.
LEAF, MAX_LEAVES, TWO_LEVELS, ASKED = 512, 1024, 16_384, 256
SELECTIVE = 4
BLOCK = 8192
ROUNDS, EPOCHS, RATE = 20, 300, 0.05


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of the ``k`` largest inner products of each row with others."""
    out = np.empty((len(x), k), np.int64)
    for lo in range(0, len(x), 512):
        s = x[lo:lo + 512] @ x.T
        s[np.arange(len(s)), lo + np.arange(len(s))] = -np.inf
        out[lo:lo + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, seed: int = 11) -> np.ndarray:
    """Cut the neighbour graph into ``parts`` parts of nearly equal size:
    begin with the nearest of ``parts`` far-apart directions, then let every
    vertex move to the part of most of its neighbours while there is room."""
    n = len(x)
    cap = int(np.ceil(n / parts * BALANCE))
    rng = np.random.default_rng(seed)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    centres = unit[rng.choice(n, parts, replace=False)]
    for _ in range(10):
        near = (unit @ centres.T).argmax(axis=1)
        for p in range(parts):
            if (near == p).any():
                c = unit[near == p].sum(axis=0)
                centres[p] = c / (np.linalg.norm(c) or 1)
    score = unit @ centres.T
    part = np.full(n, -1)
    size = np.zeros(parts, np.int64)
    for i in np.argsort(-score.max(axis=1), kind="stable"):
        for p in np.argsort(-score[i], kind="stable"):
            if size[p] < cap:
                part[i], size[p] = p, size[p] + 1
                break
    back = [[] for _ in range(n)]
    for i, row in enumerate(graph):
        for j in row:
            back[j].append(i)
    for _ in range(ROUNDS):
        moved = 0
        for i in rng.permutation(n):
            votes = np.bincount(part[np.concatenate([graph[i], np.array(back[i], np.int64)])], minlength=parts)
            own = part[i]
            votes_now = votes[own]
            votes[size >= cap] = -1
            votes[own] = votes_now
            best = int(votes.argmax())
            if votes[best] > votes_now:
                part[i] = best
                size[own] -= 1
                size[best] += 1
                moved += 1
        if moved < n // 200:
            break
    return part


def fit_router(x: np.ndarray, target: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Softmax regression on standardised vectors towards each vector's
    distribution of its neighbours' parts (Adam). Returns scale, weights, bias."""
    scale = x.std(axis=0) + 1e-9
    z = x / scale
    w = np.zeros((x.shape[1], parts))
    b = np.zeros(parts)
    m = [np.zeros_like(w), np.zeros_like(b)]
    v = [np.zeros_like(w), np.zeros_like(b)]
    for t in range(1, EPOCHS + 1):
        s = z @ w + b
        s -= s.max(axis=1, keepdims=True)
        p = np.exp(s)
        p /= p.sum(axis=1, keepdims=True)
        d = (p - target) / len(x)
        for q, g, i in ((w, z.T @ d + 1e-5 * w, 0), (b, d.sum(axis=0), 1)):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            q -= RATE * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-9)
    return scale, w, b


def _usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec): rows that take part, vectors as doubles."""
    vec = F.col(vec_col).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return (df.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"))
            .filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & ~F.exists("vec", bad)
                    & F.exists("vec", lambda x: x != 0)))


def _train(x: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    graph = neighbour_graph(x, min(NEIGHBOURS, len(x) - 1))
    part = balanced_parts(x, graph, parts)
    onehot = np.eye(parts)[part]
    return fit_router(x, 0.5 * onehot + 0.5 * onehot[graph].mean(axis=1), parts)


def _log_softmax(x: np.ndarray, router: tuple) -> np.ndarray:
    scale, w, b = router
    z = (x / scale) @ w + b
    z -= z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def _ranked_parts(x: np.ndarray, router: tuple) -> np.ndarray:
    return np.argsort(-_log_softmax(x, router), axis=1, kind="stable")


@dataclass
class Routers:
    """A router and, with two levels, one under each of its parts."""

    root: tuple
    under: list[tuple] | None = None

    @property
    def parts(self) -> int:
        return self.root[1].shape[1] if self.under is None else sum(u[1].shape[1] for u in self.under)

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """Parts of each vector, most probable first."""
        p = _log_softmax(x, self.root)
        if self.under is not None:
            p = np.concatenate([p[:, [i]] + _log_softmax(x, u) for i, u in enumerate(self.under)], axis=1)
        return np.argsort(-p, axis=1, kind="stable")


def _probes(x: np.ndarray, parts: int) -> int:
    """Fewest probes, ``PROBES`` at least, whose recall on held-out vectors is ``RECALL``."""
    order = np.random.default_rng(7).permutation(len(x))
    learned, asked = x[order[len(x) // 2:]], x[order[:len(x) // 2][:HELD_OUT]]
    router = _train(learned, parts)
    home = _ranked_parts(learned, router)[:, 0]
    place = np.argsort(_ranked_parts(asked, router), axis=1)  # of each part in a query's order
    k = min(NEAREST, len(learned))
    near = np.argpartition(-(asked @ learned.T), k - 1, axis=1)[:, :k]
    needs = place[np.arange(len(asked))[:, None], home[near]] + 1
    recall = np.cumsum(np.bincount(needs.ravel(), minlength=parts + 1)[1:]) / needs.size
    few = int(np.searchsorted(recall, RECALL)) + 1
    return min(max(few, PROBES), parts)


def _trivial(dim: int) -> tuple:
    return np.ones(dim), np.zeros((dim, 1)), np.zeros(1)


def _second_level(vectors: DataFrame, root: tuple, n: int) -> list[tuple]:
    """A router under each part of ``root``, fitted by tasks on at most
    ``SAMPLE`` of the part's vectors."""
    parts = root[1].shape[1]
    own = route(vectors, Routers(root), 1).withColumn("part", F.col("parts")[0])
    sizes = {r[0]: r[1] for r in own.groupBy("part").count().collect()}  # at most MAX_PARTS rows
    share = F.create_map(*[x for p, m in sizes.items() for x in (F.lit(p), F.lit(min(1.0, SAMPLE / m)))])
    drawn = own.filter(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 20)) < share[F.col("part")] * float(1 << 20))

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable").head(SAMPLE)
        x = np.unique(np.stack(pdf["vec"].to_numpy()).astype(np.float64), axis=0)
        part = int(pdf["part"].iloc[0])
        leaves = int(np.clip(sizes[part] // LEAF, 1, MAX_LEAVES // parts))
        leaves = min(leaves, max(len(x) // 16, 1))
        router = _train(x, leaves) if leaves > 1 else _trivial(x.shape[1])
        return pd.DataFrame({"part": [part], "router": [pickle.dumps(router)]})

    rows = drawn.select("part", "id", "vec").groupBy("part").applyInPandas(learn, "part int, router binary").collect()
    made = {r.part: pickle.loads(bytes(r.router)) for r in rows}
    return [made.get(p, _trivial(root[1].shape[0])) for p in range(parts)]


def _measured(vectors: DataFrame, ids: np.ndarray, asked: np.ndarray, routers: Routers) -> int:
    """Fewest probes that find ``RECALL`` of the exact neighbours, among all
    vectors, of the vectors ``asked``."""
    place = np.argsort(routers.ranked(asked), axis=1)
    box = vectors.sparkSession.sparkContext.broadcast((ids, asked, place, routers))

    def run(frames):
        own, asked, place, routers = box.value
        best = np.full((len(asked), 0), 0.0), np.full((len(asked), 0), 0)
        for pdf in frames:
            if not len(pdf):
                continue
            c = np.stack(pdf["vec"].to_numpy())
            s = asked @ c.T
            s[own[:, None] == pdf["id"].to_numpy()[None, :]] = -np.inf
            k = min(NEAREST, s.shape[1])
            top = np.argpartition(-s, k - 1, axis=1)[:, :k]
            home = routers.ranked(c[np.unique(top)])[:, 0]
            home = dict(zip(np.unique(top).tolist(), home.tolist()))
            where = np.array([[place[q, home[j]] for j in row] for q, row in enumerate(top.tolist())])
            score = np.concatenate([best[0], np.take_along_axis(s, top, axis=1)], axis=1)
            where = np.concatenate([best[1], where], axis=1)
            keep = np.argsort(-score, axis=1, kind="stable")[:, :NEAREST]
            best = np.take_along_axis(score, keep, axis=1), np.take_along_axis(where, keep, axis=1)
        q = np.repeat(np.arange(len(asked)), best[0].shape[1])
        yield pd.DataFrame({"q": q, "score": best[0].ravel(), "place": best[1].ravel()})

    found = vectors.select("id", "vec").mapInPandas(run, "q long, score double, place long").filter("score > double('-inf')")
    nearest = F.slice(F.reverse(F.array_sort(F.collect_list(F.struct("score", "place")))), 1, NEAREST)
    rows = found.groupBy("q").agg(nearest["place"].alias("places")).collect()  # at most ASKED rows
    needs = np.concatenate([r.places for r in rows]).astype(np.int64) if rows else np.zeros(1, np.int64)
    recall = np.cumsum(np.bincount(needs, minlength=routers.parts)) / len(needs)
    return min(int(np.searchsorted(recall, RECALL)) + 1, routers.parts)


def fit(vectors: DataFrame) -> tuple[Routers, int] | None:
    """Routers and the number of probes, from bounded samples of ``vectors``
    (id, vec); None without any."""
    rows = (vectors.orderBy(F.xxhash64("id", F.lit(3)), "id").limit(SAMPLE).select("id", "vec").collect())
    if not rows:
        return None
    drawn = np.array([r.vec for r in rows], np.float64)
    x = np.unique(drawn, axis=0)
    parts = int(np.clip(len(x) // PART_SIZE, 1, MAX_PARTS))
    if parts == 1:
        return Routers(_trivial(x.shape[1])), 1
    root = _train(x, parts)
    n = vectors.count()
    if n >= TWO_LEVELS:
        deep = Routers(root, _second_level(vectors, root, n))
        probes = _measured(vectors, np.array([r.id for r in rows[:ASKED]]), drawn[:ASKED], deep)
        if probes * SELECTIVE <= deep.parts:
            return deep, probes
    return Routers(root), _probes(x, parts)


def route(vectors: DataFrame, routers: Routers, probes: int) -> DataFrame:
    """Rows of ``vectors`` (id, vec, ...) with the ``probes`` most probable parts."""
    box = vectors.sparkSession.sparkContext.broadcast(routers)

    def run(frames):
        free_worker_tables()
        for pdf in frames:
            if len(pdf):
                yield pdf.assign(parts=list(box.value.ranked(np.stack(pdf["vec"].to_numpy()))[:, :probes]
                                            .astype(np.int32)))

    return vectors.mapInPandas(run, ", ".join(f"{c} {t}" for c, t in vectors.dtypes) + ", parts array<int>")


def _ranked(s: np.ndarray, qid: np.ndarray, flat: np.ndarray, begin: np.ndarray, k: int) -> tuple:
    """(query, id, score) of the ``k`` best ids of each row of the scores
    ``s`` of distinct vectors, whose ids are flat[begin[j]:begin[j + 1]]."""
    # the k + 1 best distinct vectors hold the k best ids (one may be the query's own),
    # with all that tie with the last of them
    n = min(k + 1, s.shape[1])
    bound = np.partition(s, s.shape[1] - n, axis=1)[:, s.shape[1] - n]
    row, col = np.nonzero(s >= bound[:, None])
    reps = begin[col + 1] - begin[col]
    at = np.repeat(begin[col] - (np.cumsum(reps) - reps), reps) + np.arange(int(reps.sum()))
    row, score, ids = np.repeat(row, reps), np.repeat(s[row, col], reps), flat[at]
    other = ids != qid[row]
    row, score, ids = row[other], score[other], ids[other]
    order = np.lexsort((ids, -score, row))
    row, score, ids = row[order], score[order], ids[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    keep = rank < k
    return qid[row[keep]], ids[keep], score[keep]


def _search(k: int):
    """Reads rows (part, block, query, vec, ids) sorted by block, vectors
    (query null) first; gives (query_id, vec_id, score)."""

    def run(batches):
        free_worker_tables()
        at, vectors, flat, begin = None, [], [], []
        block = None  # the vectors of the block, once its first query comes
        for b in batches:
            n = b.num_rows
            key = np.stack([b.column(i).to_numpy() for i in (0, 1)], axis=1)
            asks = b.column(2).is_valid().to_numpy(zero_copy_only=False)
            cut = np.flatnonzero((key[1:] != key[:-1]).any(axis=1) | (asks[1:] != asks[:-1])) + 1
            for lo, hi in zip([0, *cut.tolist()] if n else [], [*cut.tolist(), n]):
                part = b.slice(lo, hi - lo)
                x = part.column(3).flatten().to_numpy(zero_copy_only=False).reshape(hi - lo, -1)
                if tuple(key[lo]) != at:
                    at, vectors, flat, begin, block = tuple(key[lo]), [], [], [], None
                if not asks[lo]:
                    vectors.append(x)
                    flat.append(part.column(4).flatten().to_numpy())
                    begin.append(part.column(4).value_lengths().to_numpy())
                    continue
                if not vectors:
                    continue
                if block is None:
                    block = (np.concatenate(vectors), np.concatenate(flat),
                             np.concatenate([[0], np.cumsum(np.concatenate(begin))]))
                    vectors, flat, begin = [block[0]], [block[1]], [np.diff(block[2])]
                qid = part.column(2).to_numpy()
                for i in range(0, hi - lo, 128):
                    q, ids, score = _ranked(x[i:i + 128] @ block[0].T, qid[i:i + 128], block[1], block[2], k)
                    yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(ids), pa.array(score)],
                                                     ["query_id", "vec_id", "score"])

    return run


def _distinct(vectors: DataFrame, k: int) -> DataFrame:
    """(id, vec, ids): distinct vectors with their ``k`` smallest ids, and the
    smallest. Hot vectors are cut down in salted groups first."""
    ranked = W.partitionBy("h1", "h2", "salt").orderBy("id")
    again = W.partitionBy("h1", "h2").orderBy("id")
    hashed = (vectors.dropDuplicates(["id", "vec"]).withColumn("h1", F.xxhash64("vec"))
              .withColumn("h2", F.xxhash64(F.lit(1), "vec"))
              .withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(256))))
    few = (hashed.withColumn("r", F.row_number().over(ranked)).filter(F.col("r") <= k)
           .withColumn("r", F.row_number().over(again)).filter(F.col("r") <= k))
    return (few.groupBy("h1", "h2").agg(F.any_value("vec").alias("vec"),
                                        F.sort_array(F.collect_list("id")).alias("ids"))
            .select(F.col("ids")[0].alias("id"), "vec", "ids"))


def nearest(vectors: DataFrame, is_query: Callable[[Column], Column], k: int = 20, probes: int | None = None,
            id_col: str = "vec_id", vec_col: str = "embedding", routers: Routers | None = None,
            scored: list | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row
    for which ``is_query``, a function of the id column, holds. ``probes``
    replaces the measured number; ``routers`` that are given without it
    search all parts. ``scored``, a list, gets (pairs of a query and a distinct
    vector that are scored, all such pairs)."""
    usable = _usable(vectors.filter(F.col(vec_col).isNotNull()), id_col, vec_col)
    nothing = usable.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"),
                            F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    sizes = usable.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if sizes is None:
        return nothing
    usable = usable.filter(F.size("vec") == sizes["n"])
    with Scratch(vectors.sparkSession) as scratch:
        distinct = scratch.stage(_distinct(usable, k + 1), "ann-vectors")
        measured = None
        if routers is None:
            routers, measured = fit(distinct.select("id", "vec"))
        probes = min(probes or measured or routers.parts, routers.parts)
        index = scratch.stage(route(distinct, routers, 1).select("vec", "ids", F.col("parts")[0].alias("part")),
                              "ann-index")
        scratch.drop(distinct)
        queries = scratch.stage(
            route(usable.filter(is_query(F.col("id"))).dropDuplicates(["id", "vec"]), routers, probes)
            .select("id", "vec", F.explode("parts").alias("part")), "ann-queries")
        # a row per part: at most MAX_LEAVES
        sizes = {r[0]: r[1] for r in index.groupBy("part").count().collect()}
        if scored is not None:
            asked = {r[0]: r[1] for r in queries.groupBy("part").count().collect()}
            scored.append((sum(n * sizes.get(p, 0) for p, n in asked.items()),
                           sum(asked.values()) // probes * sum(sizes.values())))
        blocks = F.create_map(*[F.lit(x) for p, n in sizes.items() for x in (p, -(-n // BLOCK))])[F.col("part")]
        there = index.select(
            "part", F.pmod(F.xxhash64(F.col("ids")[0]), blocks).cast("int").alias("block"),
            F.lit(None).cast("long").alias("query"), "vec", "ids")
        ask = queries.withColumn("blocks", blocks).filter("blocks is not null").select(
            "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
            F.col("id").alias("query"), "vec", F.lit(None).cast("array<long>").alias("ids"))
        rows = there.unionByName(ask).repartition("part", "block").sortWithinPartitions(
            "part", "block", F.col("query").asc_nulls_first())
        found = rows.mapInArrow(_search(k), "query_id long, vec_id long, score double")
        # the same id may be found with two vectors; the nearest counts
        order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return staged(best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
                      .select("query_id", "rank", "vec_id", "score"), "nearest")
