"""Connected components of an edge table by alternating star contractions."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sitewright.session import checkpoint


def _star(large: bool):
    """Rows (u, v) ordered by u, then v: hang v on the smallest of u and its neighbours; for small stars u as well.

    The smallest neighbour comes first, so a node with any number of neighbours passes through row by row.
    """
    def run(batches):
        node = low = None
        for b in batches:
            u, v = b.column(0).to_numpy(), b.column(1).to_numpy()
            if not len(u):
                continue
            fresh = np.concatenate([[node is None or u[0] != node], u[1:] != u[:-1]])
            start = np.flatnonzero(fresh)
            least = np.minimum(u[start], v[start]) if large else v[start]
            if not fresh[0]:
                start, least = np.concatenate([[0], start]), np.concatenate([[low], least])
            m = np.repeat(least, np.diff(np.append(start, len(u))))
            keep = v > u if large else v != m
            a, z = v[keep], m[keep]
            if not large:
                a, z = np.concatenate([u[fresh], a]), np.concatenate([m[fresh], z])
            node, low = u[-1], m[-1]
            pair = np.unique(np.stack([a, z]), axis=1)
            pair = pair[:, pair[0] != pair[1]]
            yield pa.RecordBatch.from_arrays([pa.array(pair[0], pa.int64()), pa.array(pair[1], pa.int64())], ["u", "v"])

    return run


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected ``links`` (a, b): root is the smallest node reachable from it.

    Each round hangs a node's larger neighbours on its smallest one, then its smaller ones; a star per component is left after about
    log(nodes) rounds.  A round shuffles the edges twice, sorted by node, and never gathers a node's neighbours.
    """
    deal = lambda x: x.repartition("u").sortWithinPartitions("u", "v")
    e = checkpoint(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v"))
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        e = deal(both).mapInArrow(_star(True), "u long, v long")
        e = checkpoint(deal(e).mapInArrow(_star(False), "u long, v long").distinct())
        state = e.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x")).first()
        if state == before or state["n"] == 0:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = state
