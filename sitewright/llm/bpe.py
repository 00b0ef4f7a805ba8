"""Byte-pair encoding by a table of distinct words, and decoding by a join of ids with their pieces.

Texts are split at white space, which no token of the given tokenizer crosses.  Documents are cut into blocks of about BLOCK bytes.  A
block's distinct words are dealt out by hash; each part of the word table sees a word from all blocks and encodes it once, then sends
the ids back to the block as a list aligned with the block's own word list.  The block, which splits its texts the same way again, joins
the ids back by position.  A word table part holds the distinct words of its part; a block task
holds one block's compressed pieces and distinct words, and the texts of one piece.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sitewright.llm.textblocks import releasing

BLOCK = 24 << 20
PARTS = 512
#: Characters of text that are spread out at once: in a piece of a block, and in the rows given out together.
PIECE = 2 << 20
OUT = 1 << 20


def load_tokenizer(text: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(text)
    t.no_truncation()
    t.no_padding()
    return t


def _pieces(batches, text_at: int, size: int):
    """(record batch, its texts as bytes, whether a block ends here): blocks of about ``size`` characters, PIECE at most held at once;
    the cut depends on the rows and their order only."""
    held = 0
    for b in batches:
        texts, start, some = [], 0, 0
        for i, x in enumerate(b.column(text_at)):
            x = x.as_py() or ""
            texts.append(x.encode())
            held += len(x)
            some += len(x)
            if held >= size or some >= PIECE:
                yield b.slice(start, i + 1 - start), texts, held >= size
                texts, start, some, held = [], i + 1, 0, 0 if held >= size else held
        if texts:
            yield b.slice(start), texts, False


class _Key:
    """A number of all the texts of a block, taken up one by one."""

    def __init__(self):
        self.h = hashlib.blake2b(digest_size=8)

    def add(self, texts: list[bytes]) -> None:
        for t in texts:
            self.h.update(len(t).to_bytes(8, "little"))
            self.h.update(t)

    def value(self) -> int:
        return int.from_bytes(self.h.digest(), "little", signed=True)


def _dealt(seen: set[bytes], parts: int) -> list[list[bytes]]:
    """The distinct words of a block by part, in one order that depends on the words alone."""
    from sitewright.llm.textblocks import Block

    words = sorted(seen)
    part = (Block([b" ".join(words)], fold=False).word_hashes() >> np.uint64(17)) % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    cut = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
    order = order.tolist()
    return [[words[k] for k in order[cut[p]:cut[p + 1]]] for p in range(parts)]


def encode(docs: DataFrame, tokenizer_json: str, *, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), block: int = BLOCK,
           parts: int = PARTS) -> DataFrame:
    """``keep`` columns of every row with ``n_tokens``, ``ids`` (little-endian unsigned 32-bit integers) and ``decoded``.

    Equals the tokenizers library's encode without special tokens, truncation and padding, and its decode without skipping any.
    ``tokenizer_json`` is the text of a tokenizer file without a decoder, whose pieces then join with a space.  A null or empty text and
    one of white space have no ids; repeated rows are encoded row by row; an empty table gives an empty one.  Other columns are left
    out; a kept column named like a result is an error.
    """
    spark = docs.sparkSession
    known = {"n_tokens", "ids", "decoded"} & set(keep)
    if known:
        raise ValueError(f"rename {sorted(known)} first")
    shared = spark.sparkContext.broadcast(tokenizer_json)
    inner = docs.select(*keep, F.col(text_col).alias("_text"))
    text_at = len(keep)

    def words(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=1)
        key, seen, any_ = _Key(), set(), False

        def close():
            rows = [(p, pack.compress(b" ".join(w))) for p, w in enumerate(_dealt(seen, parts)) if w]
            return pa.RecordBatch.from_arrays([pa.array([key.value()] * len(rows), pa.int64()), pa.array([p for p, _ in rows], pa.int32()),
                                               pa.array([w for _, w in rows], pa.binary())], ["block", "part", "data"])

        for _, texts, ends in _pieces(batches, text_at, block):
            key.add(texts)
            for t in texts:
                seen.update(t.split())
            any_ = not ends
            if ends:
                yield close()
                key, seen = _Key(), set()
        if any_:
            yield close()

    def encode_words(batches):
        import zstandard

        pack, unpack = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
        tokenizer, known, now = None, {}, None
        for b in batches:
            out = []
            for part, data in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                tokenizer = tokenizer or load_tokenizer(shared.value)
                if part != now:
                    known, now = {}, part
                ws = unpack.decompress(data).split()
                new = [w for w in ws if w not in known]
                for w, e in zip(new, tokenizer.encode_batch([w.decode() for w in new], add_special_tokens=False)):
                    known[w] = np.array(e.ids, "<u4")
                got = [known[w] for w in ws]
                counts = np.fromiter(map(len, got), "<u4", len(got))
                out.append(pack.compress(counts.tobytes() + np.concatenate(got).astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], ["block", "part", "data"])

    def payload(batches):
        key, packed = _Key(), []

        def close():
            return pa.RecordBatch.from_arrays([pa.array([key.value()] * len(packed), pa.int64()), pa.array([parts] * len(packed), pa.int32()),
                                               pa.array(packed, pa.binary())], ["block", "part", "data"])

        for some, texts, ends in _pieces(batches, text_at, block):
            key.add(texts)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, some.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_batch(some)
            packed.append(sink.getvalue().to_pybytes())
            if ends:
                yield close()
                key, packed = _Key(), []
        if packed:
            yield close()

    def join_back(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        pieces, ids_of, packed, now = None, {}, [], None

        def texts_of(data):
            """The rows of one piece, a few at a time, with their texts."""
            for b in pa.ipc.open_stream(data):
                yield from _pieces([b], text_at, OUT)

        def settle():
            seen = set()
            for data in packed:
                for _, texts, _ in texts_of(data):
                    for t in texts:
                        seen.update(t.split())
            found, shown = {}, {}
            for p, ws in enumerate(_dealt(seen, parts)):
                if not ws:
                    continue
                raw = np.frombuffer(unpack.decompress(ids_of[p]), "<u4")
                ends = np.cumsum(raw[:len(ws)])
                ids = raw[len(ws):]
                assert ends[-1] == len(ids), "the table changed while it was read"
                data_, at = ids.tobytes(), 0
                names = [pieces[i] for i in ids.tolist()]
                for w, e in zip(ws, ends.tolist()):
                    found[w] = data_[4 * at:4 * e]
                    shown[w] = b" ".join(names[at:e])
                    at = e
            for data in packed:
                for some, texts, _ in texts_of(data):
                    codes, plain = [], []
                    for t in texts:
                        ws = t.split()
                        codes.append(b"".join(map(found.__getitem__, ws)))
                        plain.append(b" ".join(filter(None, map(shown.__getitem__, ws))).decode())
                    yield pa.RecordBatch.from_arrays([*(some.column(c) for c in range(text_at)), pa.array([len(c) // 4 for c in codes], pa.int64()),
                                                      pa.array(codes, pa.binary()), pa.array(plain, pa.string())], [*keep, "n_tokens", "ids", "decoded"])

        for b in batches:
            for key, part, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if key != now:
                    if packed:
                        yield from settle()
                    ids_of, packed, now = {}, [], key
                if pieces is None:
                    tokenizer = load_tokenizer(shared.value)
                    pieces = [(tokenizer.id_to_token(i) or "").encode() for i in range(max(tokenizer.get_vocab().values()) + 1)]
                    del tokenizer
                if part < parts:
                    ids_of[part] = data.as_py()
                else:
                    packed.append(data.as_py())
        if packed:
            yield from settle()

    row = "block long, part int, data binary"
    table = inner.mapInArrow(releasing(words), row).repartition("part").sortWithinPartitions("part").mapInArrow(releasing(encode_words), row)
    both = table.unionByName(inner.mapInArrow(releasing(payload), row)).repartition("block").sortWithinPartitions("block", "part")
    schema = T.StructType([*inner.select(*keep).schema.fields, T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
                           T.StructField("decoded", T.StringType())])
    return both.mapInArrow(releasing(join_back), schema)
