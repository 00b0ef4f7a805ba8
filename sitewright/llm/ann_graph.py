"""Approximate nearest neighbours by robust-pruned directed graphs, one per shard; beam search asks every shard.

Equal vectors are one node that carries its smallest ids, so copies neither crowd a shard nor cut the graph.  Nodes are dealt to shards
by a hash of the vector; a shard is built in one task, written once and then searched by blocks of queries.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sitewright.session import checkpoint

SHARD_ROWS = 4096
QUERY_BLOCK = 2048


def usable(vec: Column) -> Column:
    """Vectors that take part: not null, not empty, not zero, all components present and finite."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vec.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vec, lambda x: x != 0)


def distances(x: np.ndarray, at: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distances of q[i] to x[at[i, j]]."""
    d = x[at] - q[:, None, :]
    return np.einsum("ijk,ijk->ij", d, d)


def beam_search(x: np.ndarray, graph: np.ndarray, entry: int, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Greedy best-first walks from ``entry``, all queries side by side: the ``beam`` closest nodes met and their squared distances."""
    m, n = len(q), len(x)
    ids = np.full((m, beam), entry)
    d = np.full((m, beam), np.inf, np.float32)
    d[:, 0] = distances(x, ids[:, :1], q)[:, 0]
    done = np.zeros((m, beam), bool)
    seen = np.zeros((m, n + 1), bool)
    seen[:, entry] = True
    rows = np.arange(m)
    live = rows
    while len(live):
        open_d = np.where(done[live], np.inf, d[live])
        pick = open_d.argmin(1)
        more = np.isfinite(open_d[np.arange(len(live)), pick])
        live, pick = live[more], pick[more]
        if not len(live):
            break
        done[live, pick] = True
        near = graph[ids[live, pick]]
        fresh = ~seen[live[:, None], near] & (near < n)
        seen[live[:, None], near] = True
        nd = np.where(fresh, distances(x, np.minimum(near, n - 1), q[live]), np.inf).astype(np.float32)
        all_d = np.concatenate([d[live], nd], 1)
        order = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
        d[live] = np.take_along_axis(all_d, order, 1)
        ids[live] = np.take_along_axis(np.concatenate([ids[live], near], 1), order, 1)
        done[live] = np.take_along_axis(np.concatenate([done[live], np.zeros(near.shape, bool)], 1), order, 1)
    return ids, d


def robust_prune(x: np.ndarray, own: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For node own[i] keep up to ``degree`` of cand[i]: the closest, then the closest that no kept one is ``alpha`` times closer to.

    The value len(x) stands for no node."""
    n, m = len(x), len(own)
    cand = np.sort(cand, 1)
    cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = n
    cand[cand == own[:, None]] = n
    d = np.where(cand < n, distances(x, np.minimum(cand, n - 1), x[own]), np.inf)
    order = np.argsort(d, axis=1, kind="stable")
    cand, d = np.take_along_axis(cand, order, 1), np.take_along_axis(d, order, 1)
    v = x[np.minimum(cand, n - 1)]
    square = np.einsum("ijk,ijk->ij", v, v)
    between = np.maximum(square[:, :, None] + square[:, None, :] - 2 * np.matmul(v, v.transpose(0, 2, 1)), 0)
    alive = np.isfinite(d)
    out = np.full((m, degree), n)
    rows = np.arange(m)
    for k in range(degree):
        first = alive.argmax(1)
        some = alive[rows, first]
        if not some.any():
            break
        out[some, k] = cand[rows, first][some]
        alive &= ~(alpha * alpha * between[rows, first] <= d) | ~some[:, None]
        alive[rows, first] = False
    return out


def build(x: np.ndarray, *, degree: int = 24, beam: int = 40, alpha: float = 1.2, batch: int = 256, seed: int = 1) -> tuple[np.ndarray, int]:
    """Neighbour lists (len(x) for none) and the entry node.  Two passes over the nodes in a seeded order: search, prune, link back."""
    n = len(x)
    rng = np.random.default_rng(seed)
    entry = int(((x - x.mean(0)) ** 2).sum(1).argmin())
    graph = np.full((n, degree), n)
    if n > 1:
        few = min(degree // 2, n - 1)
        graph[:, :few] = (np.arange(n)[:, None] + rng.integers(1, n, (n, few))) % n
    for a in (1.0, alpha):
        order = rng.permutation(n)
        for start in range(0, n, batch):
            own = order[start:start + batch]
            found, d = beam_search(x, graph, entry, x[own], beam)
            cand = np.concatenate([np.where(np.isfinite(d), found, n), graph[own]], 1)
            graph[own] = robust_prune(x, own, cand, degree, a)
            source = np.repeat(own, degree)
            target = graph[own].ravel()
            ok = target < n
            source, target = source[ok], target[ok]
            by = np.argsort(target, kind="stable")
            source, target = source[by], target[by]
            nodes, at, size = np.unique(target, return_index=True, return_counts=True)
            # nodes with many new links are pruned in groups of like size
            for low, high in ((0, 8), (8, 32), (32, 128), (128, n)):
                pick = np.flatnonzero((size > low) & (size <= high))
                for part in np.array_split(pick, max(1, len(pick) * (high + degree) // 40000)):
                    if len(part):
                        wide = int(size[part].max())
                        col = np.arange(wide)
                        new = np.where(col < size[part][:, None], source[np.minimum(at[part][:, None] + col, len(source) - 1)], n)
                        graph[nodes[part]] = robust_prune(x, nodes[part], np.concatenate([graph[nodes[part]], new], 1), degree, a)
    return graph, entry


def _pack(a: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(a, kind).tobytes()


def build_index(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", ids_kept: int = 11, shard_rows: int = SHARD_ROWS,
                degree: int = 24, beam: int = 40, alpha: float = 1.2) -> DataFrame:
    """One row per shard: dim, shard, x, graph, entry, and of every node its ``ids_kept`` smallest ids (a repeated row counts once)."""
    v = vectors.filter(usable(F.col(vec_col)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"), F.transform(vec_col, lambda c: c.cast("float") + F.lit(0.0).cast("float")).alias("v"))
    v = v.filter(usable(F.col("v")))
    v = v.withColumn("h", F.xxhash64("v")).groupBy("h", "v", "id").agg(F.lit(0)).select("h", "v", "id")
    first = Window.partitionBy("h", "v").orderBy("id")
    v = v.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= ids_kept)
    nodes = checkpoint(v.groupBy("h", "v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("dim", F.size("v")))
    sizes = {r["dim"]: r["n"] for r in nodes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    shards = F.lit(1)
    for dim, n in sizes.items():
        shards = F.when(F.col("dim") == dim, F.lit(-(-n // shard_rows))).otherwise(shards)
    nodes = nodes.withColumn("shard", F.pmod(F.col("h"), shards).cast("int"))

    def make(key, frame):
        import pandas as pd

        frame = frame.sort_values("h")
        x = np.stack(frame["v"].to_list()).astype(np.float32)
        graph, entry = build(x, degree=degree, beam=beam, alpha=alpha)
        ids = np.full((len(x), ids_kept), -1, np.int64)
        count = np.zeros(len(x), np.int64)
        for i, some in enumerate(frame["ids"]):
            ids[i, :len(some)] = some
            count[i] = len(some)
        return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "x": [_pack(x, "<f4")], "graph": [_pack(graph, "<i4")], "entry": [entry],
                             "ids": [_pack(ids, "<i8")], "counts": [_pack(count, "<i8")]})

    return nodes.groupBy("dim", "shard").applyInPandas(make, "dim int, shard int, x binary, graph binary, entry long, ids binary, counts binary")


def search(vectors: DataFrame, queries: DataFrame, *, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", beam: int = 96,
           shard_rows: int = SHARD_ROWS, degree: int = 24) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row of ``queries`` its ``k`` nearest rows of ``vectors`` other than those with its id.

    ``score`` is the Euclidean distance in double precision on the original components; ties go to the smaller id.  A vector that is
    null, empty, zero or holds a null or non-finite component takes no part on either side; vectors of another length are no candidates;
    a row that repeats id and vector counts once; with fewer candidates all are returned; an empty table gives an empty result.
    """
    index = checkpoint(build_index(vectors, id_col=id_col, vec_col=vec_col, ids_kept=k + 1, shard_rows=shard_rows, degree=degree))
    q = queries.filter(usable(F.col(vec_col)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("query_id"), F.transform(vec_col, lambda c: c.cast("float") + F.lit(0.0).cast("float")).alias("q"))
    q = checkpoint(q.filter(usable(F.col("q"))).withColumn("h", F.xxhash64("q")).distinct())
    # equal query vectors are searched once
    once = q.groupBy("h", "q").agg(F.lit(0)).select("h", "q", F.size("q").alias("dim"))
    total = once.count()
    blocks = max(1, -(-total // QUERY_BLOCK))
    once = once.withColumn("block", F.pmod("h", F.lit(blocks)).cast("int"))
    packed = once.groupBy("dim", "block").agg(F.collect_list(F.struct("h", "q")).alias("qs"))
    shards = index.select("dim", "shard")
    packed = packed.join(shards, "dim")
    pairs = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(packed, ["dim", "shard", "block"])

    def ask(batches):
        for b in batches:
            for r in b.to_pylist():
                dim = r["dim"]
                x = np.frombuffer(r["x"], "<f4").reshape(-1, dim)
                graph = np.frombuffer(r["graph"], "<i4").reshape(len(x), -1).astype(np.int64)
                ids = np.frombuffer(r["ids"], "<i8").reshape(len(x), -1)
                counts = np.frombuffer(r["counts"], "<i8")
                hs = [s["h"] for s in r["qs"]]
                qs = np.array([s["q"] for s in r["qs"]], np.float32)
                out = []
                for start in range(0, len(qs), 256):
                    part = qs[start:start + 256]
                    near, d = beam_search(x, graph, r["entry"], part, min(beam, max(k + 1, len(x))))
                    gap = np.sqrt(((x[near].astype(np.float64) - part[:, None, :].astype(np.float64)) ** 2).sum(2))
                    gap[~np.isfinite(d)] = np.inf
                    for i in range(len(part)):
                        ok = np.flatnonzero(np.isfinite(gap[i]))
                        many = counts[near[i, ok]]
                        some = ids[near[i, ok]]
                        who = some[np.arange(some.shape[1]) < many[:, None]]
                        far = np.repeat(gap[i, ok], many)
                        best = np.lexsort((who, far))[:k + 1]
                        out.append((hs[start + i], part[i], who[best], far[best]))
                n = [len(o[2]) for o in out]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat([o[0] for o in out], n), pa.int64()),
                    pa.array([o[1] for o, c in zip(out, n) for _ in range(c)], pa.list_(pa.float32())),
                    pa.array(np.concatenate([o[2] for o in out]), pa.int64()), pa.array(np.concatenate([o[3] for o in out]), pa.float64())],
                    ["h", "q", "vec_id", "score"])

    found = pairs.select("dim", "x", "graph", "entry", "ids", "counts", "qs").mapInArrow(ask, "h long, q array<float>, vec_id long, score double")
    nearest = Window.partitionBy("h", "q").orderBy("score", "vec_id")
    found = found.distinct().withColumn("n", F.row_number().over(nearest)).filter(F.col("n") <= k + 1).drop("n")
    hits = q.join(found, ["h", "q"]).filter(F.col("query_id") != F.col("vec_id"))
    rank = F.row_number().over(Window.partitionBy("query_id", "h", "q").orderBy("score", "vec_id"))
    return hits.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
