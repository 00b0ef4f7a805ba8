"""Removal of repeated byte strings by distributed suffix arrays.

Every string of LENGTH bytes has one anchor: the GRAM-byte string inside it with the smallest hash, the leftmost if there are several.
Equal strings have equal anchors, so only stretches whose anchor occurs elsewhere can repeat, and strings need comparing only under one
anchor.  Stretches are dealt out by anchor; a task sorts the string starts of half a megabyte of them in one suffix array and marks those
with a common prefix of LENGTH with a neighbour.  A stretch under a frequent anchor is cut into runs of few starts which are dealt out by
the bytes that all strings of the run share, so boilerplate spreads over tasks and its equal copies fold into one.
Documents with equal texts are one text with a count.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sitewright.llm.suffix_array import Hashes, sort_positions
from sitewright.llm.textblocks import releasing
from sitewright.session import checkpoint

LENGTH = 400
GRAM = 64
#: An anchor with more stretches than FREQUENT has them cut into runs of RUN starts.
FREQUENT = 128
RUN = 16
#: An anchor with more than one in HOT_SHARE of the repeated stretches is joined by broadcast.
HOT_SHARE = 1000
#: Contents that a task remembers.
MET = 1 << 16
BATCH = 1 << 19
#: String starts that are looked at together in a very long text.
PART = 1 << 23


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by running minima within blocks from both sides."""
    n = len(v)
    if n < width:
        return v[:0]
    padded = np.concatenate([v, np.full(-n % width, np.iinfo(v.dtype).max, v.dtype)]).reshape(-1, width)
    fore = np.minimum.accumulate(padded, 1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], fore[width - 1:n])


def stretches(text: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, anchor position, first start, last start) of the runs of string starts that share an anchor position."""
    data = np.frombuffer(text, np.uint8)
    n = len(data)
    if n < length:
        z = np.zeros(0, np.int64)
        return z, z, z, z
    h = Hashes(data).of(np.arange(n - gram + 1), gram)
    out = []
    # 40 bits of the hash, then the position: the order of two anchors is the same in every text
    for part in range(0, n - length + 1, PART):
        some = h[part:part + PART + length - gram]
        key = (some >> np.uint64(24) << np.uint64(24)) | np.arange(len(some), dtype=np.uint64)
        at = part + (sliding_min(key, length - gram + 1) & np.uint64(0xFFFFFF)).astype(np.int64)
        cut = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        out.append((h[at[cut]].view(np.int64), at[cut], part + cut, part + np.append(cut[1:], len(at)) - 1))
    return tuple(np.concatenate(x) for x in zip(*out))


def _digest(b: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(b, digest_size=8).digest(), "little", signed=True)


def _list(rows, kind):
    return pa.array(rows, pa.list_(kind))


def repeated_starts(contents: list[bytes], starts: list[int], length: int) -> list[np.ndarray]:
    """For every content, which of its first ``starts`` string starts begin a string that begins elsewhere in the list as well."""
    data = np.frombuffer(b"".join(contents), np.uint8)
    size = np.fromiter(map(len, contents), np.int64, len(contents))
    base = np.concatenate([[0], np.cumsum(size)])[:-1]
    count = np.asarray(starts, np.int64)
    wanted = np.repeat(base - np.concatenate([[0], np.cumsum(count)])[:-1], count) + np.arange(count.sum())
    order, lcp = sort_positions(data, wanted, length)
    twin = lcp >= length
    hit = np.zeros(len(data) + 1, bool)
    hit[order[twin]] = True
    hit[order[:-1][twin[1:]]] = True
    return [hit[b:b + c] for b, c in zip(base, count)]


def removals(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, frequent: int = FREQUENT, run: int = RUN, batch: int = BATCH,
             id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(texts, pieces): ``texts`` is a frame of doc_id, text, h1, h2 (a key of the text) over all rows; ``pieces`` has h1, h2, ``copies``,
    ``text`` and ``spans`` (sorted, disjoint byte intervals lo, hi to remove) for the texts that lose something."""
    if gram > length:
        raise ValueError("the anchor is longer than the string")
    t = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    t = t.withColumn("h1", F.xxhash64("text")).withColumn("h2", F.xxhash64(F.lit(7), F.reverse("text")))
    long = t.filter(F.octet_length("text") >= length)
    classes = checkpoint(long.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id")).alias("rep")))

    def find(batches):
        for b in batches:
            got = [stretches(x.encode(), length, gram) for x in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), *(_list([g[k] for g in got], pa.int64()) for k in range(4))],
                                              ["doc_id", "h1", "h2", "anchor", "at", "lo", "hi"])

    kind = t.schema["doc_id"].dataType.simpleString()
    found = long.select("doc_id", "h1", "h2", "text").mapInArrow(
        releasing(find), f"doc_id {kind}, h1 long, h2 long, anchor array<long>, at array<long>, lo array<long>, hi array<long>")
    # one row per distinct text; a row that repeats id and text stays, which only adds work
    own = found.join(classes.select("h1", "h2", F.col("rep.doc_id").alias("_rep")), ["h1", "h2"]).filter(F.col("doc_id").eqNullSafe(F.col("_rep")))
    own = checkpoint(own.select("h1", "h2", F.explode(F.arrays_zip("anchor", "at", "lo", "hi")).alias("s")).select("h1", "h2", "s.*"))
    again = checkpoint(own.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    # fewer than HOT_SHARE anchors can each hold more than that share of all stretches
    total = again.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    hot = F.broadcast(again.filter(F.col("n") * HOT_SHARE > total))
    counted = own.join(hot, "anchor").unionByName(own.join(hot.select("anchor"), "anchor", "left_anti").join(again, "anchor"))
    per_text = counted.groupBy("h1", "h2").agg(F.collect_list(F.struct("anchor", "at", "lo", "hi", "n")).alias("s"))
    per_text = classes.filter("copies > 1").select("h1", "h2", "copies").join(per_text, ["h1", "h2"], "full").withColumn(
        "copies", F.coalesce("copies", F.lit(1)))
    some = per_text.join(classes.select("h1", "h2", F.col("rep.doc_id").alias("_rep")), ["h1", "h2"])
    some = checkpoint(long.join(some, ["h1", "h2"]).filter(F.col("doc_id").eqNullSafe(F.col("_rep"))).select("h1", "h2", "copies", "text", "s"))

    def cut_out(batches):
        met: dict[tuple[int, int], int] = {}  # how often this task has met a content lately
        for b in batches:
            for i in range(b.num_rows):
                text, rows = b.column(2)[i].as_py().encode(), []
                for s in b.column(3)[i].as_py() or ():
                    lo, hi, at = s["lo"], s["hi"], s["at"]
                    if s["n"] <= frequent:
                        rows.append((s["anchor"], text[lo:hi + length], lo, hi - lo + 1))
                        continue
                    while lo <= hi:  # runs are aligned to the anchor, so equal strings are cut alike
                        first = at + (lo - at) // run * run
                        last = min(first + run - 1, hi)
                        core = text[first + run - 1:first + length]
                        key = _digest(core + (first - at).to_bytes(8, "little", signed=True) + s["anchor"].to_bytes(8, "little", signed=True))
                        rows.append((key, text[lo:last + length], lo, last - lo + 1))
                        lo = last + 1
                if rows:
                    key, content, lo, n = zip(*rows)
                    digest = [_digest(c + k.to_bytes(4, "little")) for c, k in zip(content, n)]
                    role = []
                    for pair in zip(key, digest):
                        if len(met) >= MET:  # forgetting only sends some contents once more
                            met.clear()
                        met[pair] = min(met.get(pair, 0) + 1, 3)
                        role.append(3 - met[pair])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(key, pa.int64()), pa.array(digest, pa.int64()), pa.array(role, pa.int32()),
                        pa.array([c if r == 2 else None for c, r in zip(content, role)], pa.binary()), pa.array([b.column(0)[i].as_py()] * len(rows), pa.int64()),
                        pa.array([b.column(1)[i].as_py()] * len(rows), pa.int64()), pa.array(lo, pa.int64()), pa.array(n, pa.int64())],
                        ["key", "digest", "role", "content", "h1", "h2", "lo", "starts"])

    parts = checkpoint(some.select("h1", "h2", "text", "s").mapInArrow(
        releasing(cut_out), "key long, digest long, role int, content binary, h1 long, h2 long, lo long, starts long"))

    def mark(batches):
        """Rows ordered by (key, digest): fold equal contents, sort the rest together, whole keys at a time."""
        keys, digests, contents, starts, weights, held = [], [], [], [], [], 0

        def settle(upto):
            hit = repeated_starts(contents[:upto], starts[:upto], length)
            lo, hi = [], []
            for h, w in zip(hit, weights):
                edge = np.diff(np.concatenate([[0], (h | (w > 1)).astype(np.int8), [0]]))
                lo.append(np.flatnonzero(edge == 1))
                hi.append(np.flatnonzero(edge == -1))
            out = pa.RecordBatch.from_arrays([pa.array(keys[:upto], pa.int64()), pa.array(digests[:upto], pa.int64()),
                                              _list(lo, pa.int64()), _list(hi, pa.int64())], ["key", "digest", "from", "upto"])
            for x in (keys, digests, contents, starts, weights):
                del x[:upto]
            return out

        for b in batches:
            for key, digest, content, n in zip(*(b.column(k).to_pylist() for k in range(4))):
                if keys and keys[-1] == key and digests[-1] == digest:
                    weights[-1] += 1
                    continue
                if held >= batch and keys[-1] != key:
                    yield settle(len(keys))
                    held = 0
                keys.append(key)
                digests.append(digest)
                contents.append(content)
                starts.append(n)
                weights.append(1)
                held += len(content)
        if keys:
            yield settle(len(keys))

    # a task sends a content once, and once more if it has met it again; the rest of its copies only take the result
    dealt = parts.filter("role > 0").select("key", "digest", "content", "starts", "role").repartition("key").sortWithinPartitions(
        "key", "digest", F.desc("role"))
    marked = dealt.mapInArrow(releasing(mark), "key long, digest long, from array<long>, upto array<long>")
    spans = parts.select("key", "digest", "h1", "h2", "lo").join(marked.filter(F.size("from") > 0), ["key", "digest"])
    spans = spans.select("h1", "h2", F.explode(F.arrays_zip("from", "upto")).alias("s"), "lo").select(
        "h1", "h2", (F.col("lo") + F.col("s.from")).alias("a"), (F.col("lo") + F.col("s.upto") - 1 + length).alias("b"))
    spans = spans.groupBy("h1", "h2").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("raw"))

    def union(batches):
        for b in batches:
            rows = []
            for n, copies, raw in zip(b.column(4).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                if copies > 1:
                    rows.append([{"lo": 0, "hi": n}])
                    continue
                merged = []
                for s in raw or ():
                    if merged and s["a"] <= merged[-1]["hi"]:
                        merged[-1]["hi"] = max(merged[-1]["hi"], s["b"])
                    else:
                        merged.append({"lo": s["a"], "hi": s["b"]})
                rows.append(merged)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(rows, pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))],
                                              ["h1", "h2", "spans"])

    covered = some.select("h1", "h2", "copies", F.octet_length("text").cast("long").alias("size")).join(spans, ["h1", "h2"], "left")
    covered = covered.select("h1", "h2", "copies", "raw", "size").mapInArrow(releasing(union), "h1 long, h2 long, spans array<struct<lo:long,hi:long>>")
    covered = covered.filter(F.size("spans") > 0).dropDuplicates(["h1", "h2"])
    pieces = covered.join(some.select("h1", "h2", "copies", "text").dropDuplicates(["h1", "h2"]), ["h1", "h2"])
    return t, pieces


def _apply(pieces: DataFrame) -> DataFrame:
    """(h1, h2, n_removed, n_spans, kept): the bytes left of every text that loses something."""

    def run(batches):
        for b in batches:
            removed, count, kept = [], [], []
            for text, spans in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                raw = text.encode()
                edge = [0, *(x for s in spans for x in (s["lo"], s["hi"])), len(raw)]
                kept.append(b"".join(raw[a:z] for a, z in zip(edge[::2], edge[1::2])))
                removed.append(len(raw) - len(kept[-1]))
                count.append(len(spans))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(removed, pa.int64()), pa.array(count, pa.int64()),
                                              pa.array(kept, pa.binary())], ["h1", "h2", "n_removed", "n_spans", "kept"])

    return pieces.select("h1", "h2", "text", "spans").mapInArrow(releasing(run), "h1 long, h2 long, n_removed long, n_spans long, kept binary")


def dedup_digest(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans and kept_sha256 of the bytes left.

    A byte goes if it lies in a string of ``length`` bytes (400) that also starts anywhere else in the table, in the same document or
    another one, a repeated row included; strings are judged on the input.  A null text is empty; short texts lose nothing; an empty
    table gives an empty result.
    """
    t, pieces = removals(docs, **options)
    gone = _apply(pieces).withColumn("sha", F.sha2("kept", 256)).drop("kept")
    own = t.select("doc_id", "h1", "h2", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.encode("text", "UTF-8"), 256).alias("_sha"))
    j = own.join(gone, ["h1", "h2"], "left")
    zero = F.lit(0).cast("long")
    return j.select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
                    F.coalesce("sha", "_sha").alias("kept_sha256"))


def whole_characters(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the characters all of whose bytes are covered."""
    raw = np.frombuffer(text.encode(), np.uint8)
    gone = np.zeros(len(raw) + 1, np.int64)
    for lo, hi in spans:
        gone[lo] += 1
        gone[hi] -= 1
    left = np.cumsum(gone)[:-1] == 0
    start = np.flatnonzero((raw & 0xC0) != 0x80)
    keep = np.add.reduceat(left.astype(np.int64), start) > 0
    return raw[np.repeat(keep, np.diff(np.append(start, len(raw))))].tobytes().decode()


def deduplicated(docs: DataFrame, *, text_col: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` with the repeated strings taken out of its text column; a character goes only if all its bytes are covered.

    Of documents with equal texts, all lose the whole text, as each repeats in another; a null text stays null.
    """
    _, pieces = removals(docs, text_col=text_col, id_col=id_col, **options)

    @F.pandas_udf("string")
    def shorten(text, spans):
        import pandas as pd

        return pd.Series([whole_characters(t, [(x["lo"], x["hi"]) for x in s]) for t, s in zip(text, spans)])

    left = pieces.select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), shorten("text", "spans").alias("_left"))
    h1, h2 = F.xxhash64(F.col(text_col)), F.xxhash64(F.lit(7), F.reverse(text_col))
    j = docs.join(left, (h1 == F.col("_h1")) & (h2 == F.col("_h2")) & F.col(text_col).isNotNull(), "left")
    return j.withColumn(text_col, F.coalesce("_left", text_col)).select(docs.columns)
