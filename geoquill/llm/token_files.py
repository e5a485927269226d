"""Token-id files: each document is one zstandard frame, all frames share one trained dictionary.

A file is a run of blocks, each followed by one newline:

    magic 4 bytes | index bytes u32 | frame bytes u32 | dictionary SHA-256, 32 bytes | documents u32
    index: doc_id i64, has_id u8, offset u32, length u32, tokens u32 for each document
    frames

so a short document is read by its block's index and one frame, whatever else the
block holds. Documents stand in ascending doc_id order within and across files.
Ids are serialized as little-endian u16 where the vocabulary allows, else u32.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoquill.llm.files import read_files, write_pieces
from geoquill.workspace import Workspace, partitions

MAGIC = b"TIDZ"
HEAD = "<4sII32sI"
ENTRY = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("offset", "<u4"), ("length", "<u4"), ("tokens", "<u4")])
#: Frame bytes after which a block ends.
BLOCK = 1 << 21

# White space as byte-level pre-tokenization has it.
_W = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PIECE = re.compile(f" ?[^{_W}]+|[{_W}]+(?![^{_W}])|[{_W}]+")
_RARE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_BEFORE = ("  ", "\n ", "\t ", "\r ", "\v ", "\f ")
#: Bounds of the cache of pieces in one Python worker.
CACHE_PIECES, CACHE_CHARS = 1_400_000, 40

_loaded: dict[int, Encoder] = {}


class Encoder:
    """Encodes whole texts; pieces seen before come from a cache of bounded size.

    Byte-level pre-tokenization cuts a text before every space that has no white
    space before it, so the ids of a text are those of the pieces between such
    cuts, one after another. Texts with other spaces are cut by a pattern that
    follows the rule for runs of white space. A text that holds an added token's
    string, which may be matched across pieces, is encoded whole.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(spec)
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.split, self.model = self.tok.pre_tokenizer.pre_tokenize_str, self.tok.model.tokenize
        self.direct = self.tok.normalizer is None and type(self.tok.pre_tokenizer).__name__ == "ByteLevel"
        self.cache: dict[str, bytes] = {}  # of pieces without the space that they begin with

    def whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def piece(self, text: str) -> bytes:
        """Ids of a piece: pre-tokens, then the model, without the library's wrapping of each result."""
        ids = [t.id for word, _ in self.split(text) for t in self.model(word)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def spaced(self, rest: str) -> bytes:
        out = self.piece(" " + rest)
        if len(rest) <= CACHE_CHARS and len(self.cache) < CACHE_PIECES:
            self.cache[rest] = out
        return out

    def __call__(self, text: str) -> bytes:
        """Little-endian u32 ids."""
        if not text:
            return b""
        if not self.direct or any(a in text for a in self.added):
            return self.whole(text)
        get, spaced = self.cache.get, self.spaced
        if any(w in text for w in _BEFORE) or not text.isascii() and _RARE.search(text):
            return b"".join([(get(p[1:]) or spaced(p[1:])) if p[0] == " " else self.piece(p) for p in _PIECE.findall(text)])
        first, *rest = text.split(" ")
        return b"".join([self.piece(first), *[get(p) or spaced(p) for p in rest]])


def encoder(spec: str) -> Encoder:
    key = hash(spec)
    if key not in _loaded:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _loaded[key] = Encoder(spec)
    return _loaded[key]


def pack(ids: bytes, wide: bool) -> bytes:
    return ids if wide else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def unpack(data: bytes, wide: bool) -> bytes:
    return data if wide else np.frombuffer(data, "<u2").astype("<u4").tobytes()


def train_dictionary(docs: DataFrame, spec: str, end_id: int, wide: bool, size: int = 1 << 16, sample: int = 2048, seed: int = 7) -> bytes:
    """A dictionary from the `sample` documents whose ids hash lowest, at most eight spread pieces of 2 KB of each.

    The bound (sample * 16 KB) keeps what comes to the driver fixed; it decides how
    well frames compress, never what they hold. Empty where there is too little to train on.
    """
    import zstandard as zstd

    chosen = docs.where("doc_id is not null").select("doc_id").distinct().orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(sample)
    sent = docs.sparkSession.sparkContext.broadcast(spec)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, out = encoder(sent.value), []
        for b in batches:
            for text in b.column(0).to_pylist():
                data = pack(enc(text or "") + struct.pack("<I", end_id), wide)
                step = max(2048, len(data) // 8 // 2048 * 2048)
                out += [data[i : i + 2048] for i in range(0, len(data), step)][:8]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["piece"])

    got = docs.select("doc_id", "text").join(chosen, "doc_id", "left_semi").select("text").mapInArrow(pieces, "piece binary").toArrow().column("piece").to_pylist()
    got = sorted(set(got), key=lambda p: hashlib.sha256(p).digest())
    try:
        return zstd.train_dictionary(min(size, sum(map(len, got)) // 8), got).as_bytes()
    except (zstd.ZstdError, ValueError):
        return b""


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, level: int = 3, n: int | None = None) -> None:
    """Encode docs (doc_id, text; null text: empty) and write files under path/data and the dictionary under path/dictionary.

    n: files; one holds the documents of one range of ids and should stay at some
    tens of MB of text. Repeated ids stand next to each other, null ids first.
    """
    spark = docs.sparkSession
    with open(tokenizer) as f:
        spec = f.read()
    from tokenizers import Tokenizer

    wide = max(end_id, Tokenizer.from_str(spec).get_vocab_size(with_added_tokens=True)) > 0xFFFF
    shared = train_dictionary(docs, spec, end_id, wide)
    digest = hashlib.sha256(shared).digest()
    sent = spark.sparkContext.broadcast(spec)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard as zstd

        enc, end = encoder(sent.value), struct.pack("<I", end_id)
        z = zstd.ZstdCompressor(level=level, dict_data=zstd.ZstdCompressionDict(shared) if shared else None, write_content_size=True)
        entries, frames, size = [], [], 0

        def block() -> pa.RecordBatch:
            index = np.array(entries, ENTRY).tobytes()
            body = b"".join(frames)
            return pa.RecordBatch.from_arrays([pa.array([struct.pack(HEAD, MAGIC, len(index), len(body), digest, len(entries)) + index + body], pa.binary())], names=["block"])

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                data = pack(enc(text or "") + end, wide)
                frame = z.compress(data)
                entries.append((doc or 0, doc is not None, size, len(frame), len(data) // (4 if wide else 2)))
                frames.append(frame)
                size += len(frame)
                if size >= BLOCK:
                    yield block()
                    entries, frames, size = [], [], 0
        if entries:
            yield block()

    placed = docs.select("doc_id", "text").repartitionByRange(n or partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    write_pieces(placed.mapInArrow(encode, "block binary"), f"{path}/data")
    head = struct.pack("<4sBI", MAGIC, wide, len(shared)) + shared
    write_pieces(spark.createDataFrame([(bytearray(head),)], "piece binary").coalesce(1), f"{path}/dictionary")


def read_dictionary(spark: SparkSession, path: str) -> tuple[bytes, bool]:
    head = max((bytes(r.content) for r in read_files(spark, f"{path}/dictionary").collect()), key=len)
    _, wide, n = struct.unpack_from("<4sBI", head)
    return head[9 : 9 + n], bool(wide)


def blocks(content: bytes) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """(place of the first frame, index, dictionary digest) of each block of a file."""
    at = 0
    while at < len(content):
        magic, n_index, n_frames, digest, n = struct.unpack_from(HEAD, content, at)
        if magic != MAGIC:
            raise ValueError(f"no block at byte {at}")
        yield at + struct.calcsize(HEAD) + n_index, np.frombuffer(content, ENTRY, n, at + struct.calcsize(HEAD)), digest
        at += struct.calcsize(HEAD) + n_index + n_frames + 1


def read_document(content: bytes, doc_id: int, shared: bytes, wide: bool) -> np.ndarray | None:
    """Ids of one document of a file, by the index: one frame is decompressed."""
    import zstandard as zstd

    z = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(shared) if shared else None)
    for base, index, digest in blocks(content):
        k = np.flatnonzero((index["doc_id"] == doc_id) & (index["has_id"] == 1))
        if len(k):
            if digest != hashlib.sha256(shared).digest():
                raise ValueError("another dictionary wrote this block")
            e = index[k[0]]
            return np.frombuffer(unpack(z.decompress(content[base + e["offset"] : base + e["offset"] + e["length"]]), wide), "<u4")
    return None


def read_token_files(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and the ids if asked for, from the files."""
    shared, wide = read_dictionary(spark, path)
    ws = Workspace(spark, "token-read")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard as zstd

        z = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(shared) if shared else None)
        digest = hashlib.sha256(shared).digest()
        for b in batches:
            for part, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                whole, before = content.as_buffer().to_pybytes(), 0
                for base, index, own in blocks(whole):
                    if own != digest:
                        raise ValueError("another dictionary wrote this block")
                    rows: dict[str, list] = {k: [] for k in ("doc_id", "part", "local", "n_tokens", "ids_crc32", *["ids"] * ids)}
                    for e in index:
                        data = unpack(z.decompress(whole[base + e["offset"] : base + e["offset"] + e["length"]]), wide)
                        if len(data) != 4 * e["tokens"]:
                            raise ValueError("a frame and its index differ")
                        for k, v in zip(rows, (int(e["doc_id"]) if e["has_id"] else None, part, before, int(e["tokens"]), zlib.crc32(data), np.frombuffer(data, "<u4")), strict=False):
                            rows[k].append(v)
                        before += int(e["tokens"])
                    yield pa.RecordBatch.from_arrays([pa.array(rows["doc_id"], pa.int64()), pa.array(rows["part"], pa.int32()), *(pa.array(rows[k], pa.int64()) for k in ("local", "n_tokens", "ids_crc32")), *([pa.array(rows["ids"], pa.list_(pa.int64()))] if ids else [])], names=list(rows))

    kind = "doc_id long, part int, local long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids
    docs = ws.put(read_files(spark, f"{path}/data").mapInArrow(read, kind), "read")
    # One row for each file; their running total is as long as the list of files.
    files = docs.groupBy("part").agg(F.sum("n_tokens").alias("t")).select("part", F.coalesce(F.sum("t").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return docs.join(files, "part").select("doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * ids)
