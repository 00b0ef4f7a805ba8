"""Documents joined by the Jaccard similarity of their word n-gram sets: exact, by rare-first prefixes.

Any total order of n-grams gives a complete prefix filter, so the order may come from a bounded list: n-grams seen several times in one
task's window are counted over all documents, and the MAX_RANKED most frequent ones come last, by count.  Documents with equal sets are
one node.  Prefix n-grams are joined by shuffle; a small bucket gives its pairs that pass the length and positional filters.  In a large
bucket each node is first held against one head only; whatever that leaves in different components is then paired across components, so
no link between components is lost while a group of near copies costs a few pairs per member.  A pair is checked once, by a suffix
filter on counts per hash range, then by its full sets.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sitewright.llm.components import components
from sitewright.llm.textblocks import Block, blocks, mix, MULT, ngram_hashes, releasing
from sitewright.session import checkpoint

MAX_RANKED = 1 << 17
#: Ids that may be broadcast to pick texts; more of them are joined by shuffle.
MAX_SENT_IDS = 1 << 21
SMALL_BUCKET = 24
#: Rows of one family of large buckets that are paired in one task.
TILE_ROWS = 400000
BINS = 64
#: Heads that a node of a large bucket is held against in one round, and rounds at most before all pairs across components.
HEADS, ROUNDS, MORE_HEADS = 2, 2, 16
#: Pairs across components, per row of the large buckets, that need no further round.
PAIRS_PER_ROW = 8


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of every text; fewer words than n are one n-gram, no words none."""
    b = Block(texts)
    h, counts = b.word_hashes(), b.counts()
    grams = ngram_hashes(h, n)
    out = []
    for i, c in enumerate(counts.tolist()):
        at = b.first[i]
        if c >= n:
            out.append(np.unique(grams[at:at + c - n + 1]).view(np.int64))
        elif c:
            s = np.uint64(c)
            for x in h[at:at + c]:
                s = mix(np.array([s ^ x], np.uint64) * np.uint64(MULT))[0]
            out.append(np.array([s], np.uint64).view(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def _digest(s: np.ndarray) -> tuple[int, int]:
    u = s.view(np.uint64)
    return tuple(int(x) for x in np.array([mix(u).sum(), mix(u * np.uint64(MULT) + np.uint64(1)).sum()], np.uint64).view(np.int64))


def frequent_ngrams(texts: DataFrame, n: int, *, limit: int = MAX_RANKED, window: int = 2_000_000, least: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """At most ``limit`` n-grams in most documents and their counts, as far as a window of ``window`` n-grams has them ``least`` times."""

    def count(batches):
        kept, held, seen = [], 0, set()

        def flush():
            v, c = np.unique(np.concatenate(kept), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(v[c >= least]), pa.array(c[c >= least])], ["g", "c"])

        for _, some in blocks(batches):
            for s in shingle_sets(some, n):
                d = _digest(s)
                if len(s) and d not in seen:
                    seen.add(d)
                    kept.append(s)
                    held += len(s)
            if held >= window:
                yield flush()
                kept, held, seen = [], 0, set()
        if kept:
            yield flush()

    seen = checkpoint(texts.mapInArrow(releasing(count), "g long, c long").groupBy("g").agg(F.sum("c").alias("c")).withColumn(
        "level", F.floor(8 * F.log2("c")).cast("int")))
    # the lowest level from which on no more than ``limit`` n-grams are left; there are some hundred levels
    held, lowest = 0, None
    for r in sorted(seen.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r["level"]):
        held += r["n"]
        if held > limit:
            break
        lowest = r["level"]
    top = seen.filter(F.col("level") >= (lowest if lowest is not None else 1 << 30)).select("g", "c").toPandas()
    order = np.argsort(top["g"].to_numpy(np.int64))
    return top["g"].to_numpy(np.int64)[order], top["c"].to_numpy(np.int64)[order]


def _pairs(g, pn, node, percent):
    """Pairs of rows of one bucket (equal g, rows ordered by set size) that pass the length and the positional filter."""
    size, pos = pn >> 32, pn & 0xFFFFFFFF
    a, b = [], []
    for d in range(1, len(g)):
        same = np.flatnonzero(g[d:] == g[:-d])
        if not len(same):
            break
        i, j = same, same + d
        room = 1 + np.minimum(size[i] - 1 - pos[i], size[j] - 1 - pos[j])
        ok = (percent * size[j] <= 100 * size[i]) & ((100 + percent) * room >= percent * (size[i] + size[j])) & (node[i] != node[j])
        a.append(node[i[ok]])
        b.append(node[j[ok]])
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
    return np.minimum(a, b), np.maximum(a, b)


def _bucket_pass(percent: int, small: int):
    """Rows sorted by (g, size, node) to candidate pairs of small buckets (kind 0: a, b) and the rows of large ones (kind 1: g, pn, a)."""

    def emit(kind, g, pn, a, b):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(g), pa.array(pn), pa.array(a), pa.array(b)],
                                          ["kind", "g", "pn", "a", "b"])

    def run(batches):
        held = [np.zeros(0, np.int64)] * 3
        hot = None  # the n-gram whose first rows were already passed on as a large bucket

        def settle(g, pn, node):
            if not len(g):
                return
            cut = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
            size = np.diff(np.concatenate([cut, [len(g)]]))
            width = np.repeat(size, size)
            large = (width > small) | (g == hot if hot is not None else False)
            if large.any():
                yield emit(1, g[large], pn[large], node[large], node[large])
            few = ~large & (width > 1)
            a, b = _pairs(g[few], pn[few], node[few], percent)
            if len(a):
                both = np.unique(np.stack([a, b]), axis=1)
                zero = np.zeros(both.shape[1], np.int64)
                yield emit(0, zero, zero, both[0], both[1])

        for batch in batches:
            cols = [np.concatenate([h, batch.column(k).to_numpy(zero_copy_only=False)]) for k, h in enumerate(held)]
            if not len(cols[0]):
                continue
            tail = int(np.searchsorted(cols[0], cols[0][-1]))
            yield from settle(*(c[:tail] for c in cols))
            held = [c[tail:] for c in cols]
            if held[0][0] != hot:
                hot = None
            if len(held[0]) > small:
                hot = held[0][0]
                yield emit(1, held[0], held[1], held[2], held[2])
                held = [np.zeros(0, np.int64)] * 3
        yield from settle(*held)

    return run


def _size(packed: str) -> Column:
    """Set size from a packed (size, position)."""
    return F.shiftright(packed, 32)


def _tile_pairs(percent, size, bins, gx, x, rx, gy, y, ry):
    """Pairs (x, y) of nodes that share a bucket, differ in root and pass the filters; sizes and bins by node number."""
    xs, xi = np.unique(x, return_inverse=True)
    ys, yi = np.unique(y, return_inverse=True)
    root_x, root_y = np.zeros(len(xs), np.int64), np.zeros(len(ys), np.int64)
    root_x[xi], root_y[yi] = rx, ry
    cut_x = np.searchsorted(xi[np.argsort(xi, kind="stable")], np.arange(len(xs) + 1))
    by_x = np.argsort(xi, kind="stable")
    a, b = [], []
    for k in range(len(xs)):
        mine = gx[by_x[cut_x[k]:cut_x[k + 1]]]
        lo, hi = np.searchsorted(gy, mine, "left"), np.searchsorted(gy, mine, "right")
        seen = np.unique(np.concatenate([yi[p:q] for p, q in zip(lo, hi)]))
        n, m = size[xs[k]], size[ys[seen]]
        ok = (root_y[seen] != root_x[k]) & (percent * np.maximum(n, m) <= 100 * np.minimum(n, m))
        seen, m = seen[ok], m[ok]
        most = np.minimum(bins[xs[k]], bins[ys[seen]]).sum(1)
        seen = seen[(100 + percent) * most >= percent * (n + m)]
        a.append(np.full(len(seen), xs[k]))
        b.append(ys[seen])
    return np.concatenate(a), np.concatenate(b)


def _tile_pass(percent: int):
    """Rows (top, i, j, kind, g, node, root, bins) ordered by tile, kind and g to pairs: kind 0 gives a node's set size and bins, kind 1
    the ends outside the largest component, kind 2 the members."""

    def settle(t):
        kind, g, node, root, bins = t
        if not (kind == 1).any():
            return
        ids, at = np.unique(node, return_inverse=True)
        size = np.zeros(len(ids), np.int64)
        count = np.zeros((len(ids), BINS), np.int64)
        info = kind == 0
        size[at[info]] = root[info]
        count[at[info]] = bins
        x, y = kind == 1, kind == 2
        a, b = _tile_pairs(percent, size, count, g[x], at[x], root[x], g[y], at[y], root[y])
        a, b = ids[a], ids[b]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], ["a", "b"])

    def run(batches):
        held, counts, now = [], [], None

        def close():
            return settle([*(np.concatenate(c) for c in zip(*held)), np.array(counts, np.int32).reshape(-1, BINS)])

        for batch in batches:
            if not batch.num_rows:
                continue
            tile = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3)])
            kind = batch.column(3).to_numpy()
            g, node, root = (batch.column(k).fill_null(0).to_numpy(zero_copy_only=False) for k in (4, 5, 6))
            start = np.flatnonzero(np.concatenate([[True], (tile[:, 1:] != tile[:, :-1]).any(0)]))
            for lo, hi in zip(start, np.append(start[1:], batch.num_rows)):
                if now is not None and tuple(tile[:, lo]) != now:
                    yield from close()
                    held, counts = [], []
                now = tuple(tile[:, lo])
                held.append([c[lo:hi] for c in (kind, g, node, root)])
                counts += [batch.column(7)[int(i)].as_py() for i in lo + np.flatnonzero(kind[lo:hi] == 0)]
        if held:
            yield from close()

    return run


class Join:
    """One run of the join; ``nodes`` (doc_id, n, d1, d2, bins, prefix) is the written table of all documents."""

    def __init__(self, docs: DataFrame, *, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
                 ranked: int = MAX_RANKED, small: int = SMALL_BUCKET):
        self.n, self.percent, self.small = n, percent, small
        self.docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        spark = docs.sparkSession
        rank = spark.sparkContext.broadcast(frequent_ngrams(self.docs, n, limit=ranked))

        def prefixes(batches):
            known, count = rank.value
            for ids, texts in blocks(batches):
                rows = []
                for i, s in zip(ids, shingle_sets(texts, n)):
                    size = len(s)
                    keep = size - -(-percent * size // 100) + 1 if size else 0
                    order = s
                    if size and len(known):
                        at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                        f = np.where(known[at] == s, count[at], 0)
                        order = s[np.lexsort((s, f))]
                    bins = np.bincount((s.view(np.uint64) >> np.uint64(58)).astype(np.int64), minlength=BINS).astype(np.int32)
                    rows.append((i, size, *_digest(s), bins, order[:keep]))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([
                    pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()),
                    pa.array(cols[4], pa.list_(pa.int32())), pa.array(cols[5], pa.list_(pa.int64()))], ["doc_id", "n", "d1", "d2", "bins", "prefix"])

        self.nodes = checkpoint(self.docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
            releasing(prefixes), "doc_id long, n long, d1 long, d2 long, bins array<int>, prefix array<long>"))
        #: (n, d1, d2, node): equal sets and the smallest id that has them
        self.classes = checkpoint(self.nodes.filter("n > 0 AND doc_id IS NOT NULL").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("node")))
        self.tried = self.repeats = None

    def representatives(self) -> DataFrame:
        """(node, n, prefix) of one document per class."""
        if not self._repeats():
            keys = ["n", "d1", "d2"]
            copies = checkpoint(self.nodes.select("doc_id", *keys).join(self.classes, keys).filter("doc_id <> node").select("doc_id"))
            if copies.count() <= MAX_SENT_IDS:
                rest = self.nodes.filter("n > 0 AND doc_id IS NOT NULL").join(F.broadcast(copies), "doc_id", "left_anti")
                return rest.select(F.col("doc_id").alias("node"), "n", "prefix")
        on = [*(F.col(f"c.{k}") == F.col(f"x.{k}") for k in ("n", "d1", "d2")), F.col("c.node") == F.col("x.doc_id")]
        reps = self.classes.alias("c").join(self.nodes.alias("x"), on).select("node", "x.n", "prefix", "x.d1", "x.d2")
        return (reps.dropDuplicates(["node", "n", "d1", "d2"]) if self._repeats() else reps).select("node", "n", "prefix")

    def _repeats(self) -> bool:
        """Whether any id has several rows."""
        if self.repeats is None:
            ids = self.nodes.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
            self.repeats = bool(ids.head(1))
        return self.repeats

    def sets(self, wanted: DataFrame) -> DataFrame:
        """(node, set) with the sorted n-gram hashes of the wanted nodes, read from their texts again."""
        n, total = self.n, wanted.count()
        texts = self.docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        sent = None
        if total <= MAX_SENT_IDS:
            sent = self.docs.sparkSession.sparkContext.broadcast(np.sort(wanted.toPandas()["node"].to_numpy(np.int64)))
        else:
            texts = texts.join(wanted, F.col("doc_id") == F.col("node"), "left_semi")

        def read(batches):
            for b in batches:
                if sent is not None:
                    ids = b.column(0).to_numpy()
                    at = np.minimum(np.searchsorted(sent.value, ids), max(0, len(sent.value) - 1))
                    b = b.filter(pa.array(sent.value[at] == ids if len(sent.value) else np.zeros(len(ids), bool)))
                for ids, some in blocks([b]):
                    s = shingle_sets(some, n)
                    d = [_digest(x) for x in s]
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([x[0] for x in d], pa.int64()), pa.array(
                        [x[1] for x in d], pa.int64()), pa.array([x.tobytes() for x in s], pa.binary())], ["node", "d1", "d2", "set"])

        found = texts.mapInArrow(releasing(read), "node long, d1 long, d2 long, set binary")
        return found.dropDuplicates(["node", "d1", "d2"]).select("node", "set") if self._repeats() else found.select("node", "set")

    def close(self, pairs: DataFrame, measures: DataFrame) -> DataFrame:
        """The pairs not seen before that pass the suffix filter: no more can be shared than the smaller count of every hash range."""
        p = self.percent
        pairs = pairs.select("a", "b").distinct()
        if self.tried is not None:
            pairs = pairs.join(self.tried, ["a", "b"], "left_anti")
        pairs = checkpoint(pairs)
        self.tried = pairs if self.tried is None else checkpoint(self.tried.unionByName(pairs))
        j = pairs.join(measures.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bins").alias("ba")), "a")
        j = j.join(measures.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bins").alias("bb")), "b")
        most = F.aggregate(F.zip_with("ba", "bb", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
        return checkpoint(j.filter((100 + p) * most >= p * (F.col("na") + F.col("nb"))).select("a", "b").distinct())

    def verify(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Pairs whose sets are similar enough."""
        p = self.percent
        j = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a")
        j = j.join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b")

        def check(batches):
            for batch in batches:
                x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
                ok = []
                for s, t in zip(x, y):
                    s, t = np.frombuffer(s, np.int64), np.frombuffer(t, np.int64)
                    both = len(np.intersect1d(s, t, assume_unique=True))
                    ok.append(100 * both >= p * (len(s) + len(t) - both))
                yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

        return j.select("a", "b", "sa", "sb").mapInArrow(releasing(check), "a long, b long").distinct()

    def links(self) -> DataFrame:
        """Verified links (a, b) between nodes that connect exactly what all links connect."""
        reps = self.representatives()
        index = reps.select("node", "n", F.posexplode("prefix").alias("pos", "g"))
        index = index.select("g", (F.shiftleft("n", 32) + F.col("pos")).alias("pn"), "node")
        index = index.repartition("g").sortWithinPartitions("g", "pn", "node")
        out = checkpoint(index.mapInArrow(_bucket_pass(self.percent, self.small), "kind int, g long, pn long, a long, b long"))
        large = out.filter("kind = 1").select("g", "pn", F.col("a").alias("node"))
        some = bool(large.head(1))
        pairs = out.filter("kind = 0").select("a", "b")
        if some:
            pairs = checkpoint(pairs.unionByName(self.first_heads(large)).distinct())
        ends = lambda x: x.select(F.explode(F.array("a", "b")).alias("node"))
        met = ends(pairs).unionByName(large.select("node")).distinct()
        measures = checkpoint(self.nodes.select(F.col("doc_id").alias("node"), "n", "bins").join(met, "node"))
        near = self.close(pairs, measures)
        sets = checkpoint(self.sets(checkpoint(ends(near).unionByName(large.select("node")).distinct())))
        links = checkpoint(self.verify(near, sets))
        step = 0
        while some:
            rows = checkpoint(self.open_rows(large, links))
            held = rows.groupBy("g", "root").agg(F.count(F.lit(1)).alias("m")).groupBy("g").agg(
                F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("mm"))
            work = held.agg(F.sum("m").alias("rows"), F.sum((F.col("m") * F.col("m") - F.col("mm")) / 2).alias("pairs")).first()
            if not work["rows"]:
                break
            step += 1
            last = work["pairs"] <= PAIRS_PER_ROW * work["rows"] or step > ROUNDS
            more = self.across(rows, measures) if last else self.more_heads(rows, step)
            links = checkpoint(links.unionByName(self.verify(self.close(more, measures), sets)))
            some = not last
        return links

    def first_heads(self, large: DataFrame) -> DataFrame:
        """Up to HEADS pairs per node of the large buckets: the node and heads of its buckets, drawn by seeded hashes."""
        p = self.percent
        r = large.withColumn("n", _size("pn"))
        rank = lambda k: F.xxhash64(F.lit(k), F.col("node"))
        heads = r.groupBy("g").agg(F.array(*[F.min(F.struct(rank(k).alias("rank"), F.lit(k).alias("k"), F.col("n").alias("hn"), F.col("node").alias(
            "head"))) for k in range(HEADS)]).alias("h"))
        j = r.join(heads, "g").select("node", "n", F.explode("h").alias("h")).select("node", "n", "h.*")
        j = j.filter((F.col("node") != F.col("head")) & (p * F.greatest("n", "hn") <= 100 * F.least("n", "hn")))
        j = j.groupBy("node", "k").agg(F.min(F.struct("rank", "head")).alias("h"))
        return j.select(F.least("node", "h.head").alias("a"), F.greatest("node", "h.head").alias("b"))

    def more_heads(self, rows: DataFrame, step: int) -> DataFrame:
        """Pairs of the nodes outside a bucket's largest component with drawn members of that component, one bucket per node."""
        p = self.percent
        r = rows.withColumn("n", _size("pn"))
        top = r.groupBy("g", "root").agg(F.count(F.lit(1)).alias("m")).groupBy("g").agg(F.max(F.struct("m", "root")).alias("t")).select(
            "g", F.col("t.root").alias("top"))
        r = r.join(top, "g")
        out = r.filter("root <> top").groupBy("node").agg(F.min(F.struct(F.xxhash64(F.lit(step), F.col("g")).alias("rank"), "g", "n")).alias("o"))
        drawn = F.row_number().over(Window.partitionBy("g").orderBy(F.xxhash64(F.lit(step), F.col("node")), "node"))
        heads = r.filter("root = top").withColumn("k", drawn).filter(F.col("k") <= MORE_HEADS).select(
            "g", F.col("n").alias("hn"), F.col("node").alias("head"))
        j = out.select("node", "o.g", "o.n").join(heads, "g").filter(p * F.greatest("n", "hn") <= 100 * F.least("n", "hn"))
        return j.select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b"))

    def open_rows(self, large: DataFrame, links: DataFrame) -> DataFrame:
        """Rows (g, pn, node, root) of the large buckets that hold more than one component."""
        roots = components(links)
        r = large.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        mixed = r.groupBy("g").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi")).filter("_lo <> _hi").select("g")
        return r.join(mixed, "g").select("g", "pn", "node", "root")

    def across(self, rows: DataFrame, measures: DataFrame) -> DataFrame:
        """All pairs whose ends share a large bucket, lie in different components and pass the length and suffix filters.

        Where ids repeat, a node has several sizes and only the full sets decide.
        Buckets with the same largest component are a family.  Every such pair has an end outside that component, so a task holds
        those ends and the family's members, each node once; a large family is cut into tiles of both.
        """
        keys = ["top", "i", "j"]
        top = rows.groupBy("g", "root").agg(F.count(F.lit(1)).alias("m")).groupBy("g").agg(F.max(F.struct("m", "root")).alias("t")).select(
            "g", F.col("t.root").alias("top"))
        r = checkpoint(rows.join(top, "g").select("top", "g", "node", "root"))
        tiles = r.groupBy("top").agg(F.ceil(F.count(F.lit(1)) / TILE_ROWS).cast("int").alias("t"))
        r = r.join(tiles, "top")
        own = F.pmod(F.xxhash64("node"), F.col("t")).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col("t") - 1))
        none = F.lit(None).cast("bigint")
        left = r.filter("root <> top").withColumn("i", own).withColumn("j", every).withColumn("kind", F.lit(1))
        right = r.withColumn("j", own).withColumn("i", every).withColumn("kind", F.lit(2))
        cols = [*keys, "kind", "g", "node", "root"]
        both = left.select(cols).unionByName(right.select(cols))
        about = both.select(*keys, "node").distinct().join(measures.select("node", F.col("n").alias("root"), "bins"), "node")
        about = about.withColumn("kind", F.lit(0)).withColumn("g", none)
        both = both.withColumn("bins", F.lit(None).cast("array<int>")).unionByName(about.select(*cols, "bins"))
        dealt = both.repartition(*keys).sortWithinPartitions(*keys, "kind", "g").select(*cols, "bins")
        return dealt.mapInArrow(_tile_pass(0 if self._repeats() else self.percent), "a long, b long").distinct()


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose document has the smallest id of its component.

    Of rows that share an id one stays; rows without an id all stay.
    """
    found = join_components(docs, id_col=id_col, **options).filter("doc_id IS NOT NULL")
    ids = found.groupBy("doc_id").agg(F.min("component_id").alias("c"), F.count(F.lit(1)).alias("k"))
    gone = checkpoint(ids.filter("c <> doc_id OR k > 1").select(F.col("doc_id").alias("_gone"), (F.col("c") == F.col("doc_id")).alias("_repeats")))
    left = docs.join(gone.select("_gone"), F.col(id_col) == F.col("_gone"), "left_anti")
    if not gone.filter("_repeats").head(1):
        return left
    again = docs.join(gone.filter("_repeats"), F.col(id_col) == F.col("_gone"), "left_semi")
    return left.unionByName(again.dropDuplicates([id_col]))


def join_components(docs: DataFrame, *, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, class_id (smallest id with the same set) and component_id.

    Two documents link when 100 * |intersection| >= ``percent`` * |union| of their sets of ``n``-word shingles (A-Z lower-cased);
    component_id is the smallest id reachable by links.  A text with fewer words is one shingle; a null text or one without words has
    an empty set, links with nothing and is its own component.  Rows that share an id are one node, which links if any of their texts
    does; a row without an id has null results.  Ids are 64-bit integers.  An empty table gives an empty result.
    """
    j = Join(docs, n=n, percent=percent, id_col=id_col, text_col=text_col, **options)
    links = j.links()
    if j._repeats():
        keys = ["n", "d1", "d2"]
        links = links.unionByName(j.nodes.join(j.classes, keys).select(F.col("doc_id").alias("a"), F.col("node").alias("b")).filter("a <> b"))
    roots = components(links)
    own = j.classes.join(roots, "node", "left").select("n", "d1", "d2", F.col("node").alias("class_id"), F.coalesce("root", "node").alias("root"))
    rows = j.nodes.select("doc_id", F.col("n").alias("_n"), F.col("d1").alias("_1"), F.col("d2").alias("_2"))
    on = (F.col("_n") == F.col("n")) & (F.col("_1") == F.col("d1")) & (F.col("_2") == F.col("d2")) & F.col("doc_id").isNotNull()
    out = rows.join(own, on, "left")
    return out.select("doc_id", F.col("_n").alias("n_shingles"), F.coalesce("class_id", "doc_id").alias("class_id"),
                      F.coalesce("root", "doc_id").alias("component_id"))
