"""Token ids in a binary file format of patched frame-of-reference blocks.

A token file is a folder: `segments` holds files that are segments one after the other, `manifest` holds JSON lines that
say for each part of the id order where its ids start in the whole. A segment, all little-endian:

    header   magic 'TLPF', u32 version, u32 block size, u32 documents, u64 ids, u32 blocks, u8 kind of the keys,
             u64 part, u64 place of the first id in the part, u64 bytes of the segment
    keys     a byte for each document (1: it has no id), then i64 for each (kind 0), or u32 length for each and the
             UTF-8 of all (kind 1)
    lengths  u32 for each document
    index    u32 for each block and one more: where the block starts, counted from the end of the index
    block    u32 minimum, u8 width, u16 exceptions, the packed values (block size x width bits, low bit first),
             then u16 place and u32 value less the minimum for each exception
    end      a line feed

The width is that of the percentile, of a few tried, that makes the block smallest; values above it are packed as their
low bits and stored whole in the exception list. Documents are range-partitioned and sorted by id and a hash of the text,
so that segments in order hold all ids in ascending id order, however many rows share an id; the start of each range comes
from one count for each range. Segments are written by Spark's own sink, one record each, so that its commit protocol
makes a lost executor or a repeated task harmless and any file system that Spark knows will do.

Defined cases: a null or empty text is the end id alone; rows that share an id follow each other in the order of a hash of
their texts, equal texts side by side; rows without an id come first; no rows make no segment; block contents are 32-bit
ids of any size; ids of documents are whole numbers or strings; columns of other names, whatever they are, are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from townlens.llm.common import narrow, only_memo, shared_dir
from townlens.llm.vocab import MEMO, byte_ids

MAGIC, VERSION, BLOCK = b"TLPF", 2, 1024
PERCENTILES = (100.0, 99.0, 97.0, 90.0)
HEADER = struct.Struct("<4sIIIQIBQQQ")
BLOCK_HEAD = struct.Struct("<IBH")
#: Ids of a segment and segments of a file. A file is read as one value, of which JVM and worker hold several copies at a time:
#: some 4 MB of 16-bit ids.
SEGMENT_IDS, FILE_SEGMENTS = 1 << 17, 16


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def _pack(rows: np.ndarray, width: int) -> np.ndarray:
    """The low bits of each value, one after the other; widths of whole bytes need no bit work."""
    if width in (8, 16, 32):
        return rows.astype(f"<u{width // 8}").view(np.uint8).reshape(len(rows), -1)
    kind, wide = ("<u2", 16) if width <= 16 else ("<u4", 32)
    bits = np.unpackbits(rows.astype(kind).view(np.uint8), axis=1, bitorder="little").reshape(len(rows), -1, wide)
    return np.packbits(bits[:, :, :width].reshape(len(rows), -1), axis=1, bitorder="little")


def _unpack(packed: np.ndarray, width: int, block: int) -> np.ndarray:
    if width in (8, 16, 32):
        return packed.view(f"<u{width // 8}").astype(np.uint32)
    bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(packed), block, width)
    wide = np.zeros((len(packed), block, 32 if width > 16 else 16), dtype=np.uint8)
    wide[:, :, :width] = bits
    return np.packbits(wide, axis=2, bitorder="little").view("<u4" if width > 16 else "<u2")[:, :, 0].astype(np.uint32)


def encode_segment(ids: np.ndarray, lengths: np.ndarray, block: int = BLOCK, percentiles: tuple[float, ...] = PERCENTILES, keys: list | None = None, part: int = 0, offset: int = 0) -> bytes:
    """ids: uint32 of all documents in turn; lengths: ids of each document; keys: the documents' own ids (default: none)."""
    n_blocks = -(-len(ids) // block)
    padded = np.zeros(n_blocks * block, dtype=np.uint32)
    padded[: len(ids)] = ids
    if len(ids) % block:
        padded[len(ids) :] = ids[-1]
    rows = padded.reshape(n_blocks, block)
    low = rows.min(axis=1) if n_blocks else np.zeros(0, dtype=np.uint32)
    rows = rows - low[:, None]
    ranks = [min(block - 1, int(np.ceil(block * p / 100)) - 1) for p in percentiles]
    top = _widths(rows.max(axis=1)) if n_blocks else np.zeros(0, dtype=np.int64)
    tried = np.repeat(top[:, None], len(ranks), axis=1)
    # Only where few values need the full width can a percentile be narrower.
    wide = np.count_nonzero(rows >> np.maximum(top - 1, 0).astype(np.uint32)[:, None], axis=1)
    few = np.nonzero(wide < block - min(ranks))[0]
    if len(few):
        tried[few] = _widths(np.partition(rows[few], ranks, axis=1)[:, ranks])
    over = np.zeros(tried.shape, dtype=np.int64)
    for k in range(len(ranks)):
        at = np.nonzero(tried[:, k] < top)[0]
        over[at, k] = np.count_nonzero(rows[at] >> tried[at, k].astype(np.uint32)[:, None], axis=1)
    cost = tried * (block // 8) + over * 6
    best = cost.argmin(axis=1)
    width, n_over = tried[np.arange(n_blocks), best], over[np.arange(n_blocks), best]
    bodies: list[bytes] = [b""] * n_blocks
    for w in np.unique(width):
        at = np.nonzero(width == w)[0]
        packed = _pack(rows[at], int(w)) if w else np.zeros((len(at), 0), dtype=np.uint8)
        for k, p in zip(at, packed):
            places = np.nonzero(rows[k] >> np.uint32(w))[0] if w < 32 else np.zeros(0, dtype=np.int64)
            extra = b"".join((places.astype("<u2").tobytes(), rows[k][places].astype("<u4").tobytes())) if len(places) else b""
            bodies[k] = BLOCK_HEAD.pack(int(low[k]), int(w), int(n_over[k])) + p.tobytes() + extra
    starts = np.zeros(n_blocks + 1, dtype="<u4")
    np.cumsum([len(b) for b in bodies], out=starts[1:])
    kind, named = _pack_keys(keys if keys is not None else [None] * len(lengths))
    inner = b"".join([named, lengths.astype("<u4").tobytes(), starts.tobytes(), *bodies])
    return HEADER.pack(MAGIC, VERSION, block, len(lengths), len(ids), n_blocks, kind, part, offset, HEADER.size + len(inner)) + inner


def _pack_keys(keys: list) -> tuple[int, bytes]:
    gone = bytes(k is None for k in keys)
    if all(k is None or isinstance(k, int) for k in keys):
        return 0, gone + np.array([k or 0 for k in keys], dtype="<i8").tobytes()
    said = [b"" if k is None else str(k).encode() for k in keys]
    return 1, gone + np.array([len(x) for x in said], dtype="<u4").tobytes() + b"".join(said)


def _unpack_keys(data, kind: int, at: int, n: int) -> tuple[list, int]:
    """The keys and where they end."""
    gone, at = bytes(data[at : at + n]), at + n
    if kind == 0:
        return [None if g else k for g, k in zip(gone, np.frombuffer(data, "<i8", n, at).tolist())], at + 8 * n
    sizes, at, keys = np.frombuffer(data, "<u4", n, at).tolist(), at + 4 * n, []
    for g, size in zip(gone, sizes):
        keys.append(None if g else bytes(data[at : at + size]).decode())
        at += size
    return keys, at


def headers(data) -> list[tuple[int, tuple]]:
    """Where each segment of a file starts, and its header."""
    out, at = [], 0
    while at < len(data):
        h = HEADER.unpack_from(data, at)
        if h[0] != MAGIC or h[1] != VERSION:
            raise ValueError("not a token segment of this version")
        out.append((at, h))
        at += h[-1] + 1  # the line feed
    return out


def decode_segment(data) -> tuple[np.ndarray, np.ndarray]:
    """The ids and document lengths of a segment."""
    return decode_whole(data)[:2]


def decode_whole(data) -> tuple[np.ndarray, np.ndarray, list]:
    """The ids, the document lengths and the documents' own ids of a segment."""
    _, _, block, n_docs, n_ids, n_blocks, kind, *_ = HEADER.unpack_from(data)
    keys, at = _unpack_keys(data, kind, HEADER.size, n_docs)
    lengths = np.frombuffer(data, "<u4", n_docs, at)
    starts = np.frombuffer(data, "<u4", n_blocks + 1, at + 4 * n_docs).astype(np.int64) + at + 4 * (n_docs + n_blocks + 1)
    heads = [BLOCK_HEAD.unpack_from(data, s) for s in starts[:-1].tolist()]
    out = np.zeros((n_blocks, block), dtype=np.uint32)
    raw = np.frombuffer(data, np.uint8)
    widths = np.array([h[1] for h in heads], dtype=np.int64)
    for w in np.unique(widths):
        if w:
            rows = np.nonzero(widths == w)[0]
            packed = raw[(starts[rows] + BLOCK_HEAD.size)[:, None] + np.arange(block * w // 8)]
            out[rows] = _unpack(packed, int(w), block)
    for k, (_, w, n_over) in enumerate(heads):
        if n_over:
            s = int(starts[k]) + BLOCK_HEAD.size + block * w // 8
            out[k][np.frombuffer(data, "<u2", n_over, s)] = np.frombuffer(data, "<u4", n_over, s + 2 * n_over)
    out += np.array([h[0] for h in heads], dtype=np.uint32)[:, None]
    return out.reshape(-1)[:n_ids], lengths, keys


def write_token_file(docs: DataFrame, path: str | None = None, tokenizer: str = "byte_bpe_50k.json", end_id: int | None = 2, id_col: str = "doc_id", text: str = "text", segment_ids: int = SEGMENT_IDS, memo: int = MEMO) -> str:
    """Encode every text and write the token file in ascending id order; its path (by default a new one in the shared
    folder) comes back."""
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark)}/townlens/tokens-{uuid.uuid4().hex}"
    source = narrow(docs, id_col, text).withColumn("tie", F.xxhash64("text"))
    tail = np.array([end_id] if end_id is not None else [], dtype="<u4").tobytes()

    def run(batches):
        only_memo("byte ids", byte_ids.cache_clear)
        encode, part = byte_ids(tokenizer, memo), TaskContext.get().partitionId()
        held: list[tuple[object, bytes]] = []
        size = offset = 0

        def flush():
            nonlocal held, size, offset
            ids = np.frombuffer(b"".join(x for _, x in held), dtype="<u4")
            payload = encode_segment(ids, np.array([len(x) // 4 for _, x in held]), keys=[k for k, _ in held], part=part, offset=offset)
            offset, held, size = offset + len(ids), [], 0
            return pa.RecordBatch.from_arrays([pa.array([payload], pa.binary())], ["payload"])

        for b in batches:
            keys, texts = b.column("doc_id").to_pylist(), b.column("text")
            for at in range(0, len(keys), 256):
                for k, x in zip(keys[at : at + 256], encode(texts.slice(at, 256).to_pylist())):
                    held.append((k, x + tail))
                    size += len(x) // 4 + 1
                    if size >= segment_ids:
                        yield flush()
        if held:
            yield flush()

    ordered = source.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    segments = ordered.select("doc_id", "text").mapInArrow(run, "payload binary")
    # a string column keeps the bytes as they are, and the sink ends each record with a line feed
    segments.select(F.col("payload").cast("string").alias("value")).write.option("lineSep", "\n").option("compression", "none").option("maxRecordsPerFile", FILE_SEGMENTS).text(f"{path}/segments")

    def outline(batches):
        only_memo("token blocks", _nothing)
        for b in batches:
            found = [h for data in _contents(b) for _, h in headers(data)]
            yield pa.RecordBatch.from_arrays([pa.array([h[7] for h in found], pa.int64()), pa.array([h[3] for h in found], pa.int64()), pa.array([h[4] for h in found], pa.int64())], ["part", "docs", "ids"])

    parts = _segments(spark, path).mapInArrow(outline, "part long, docs long, ids long").groupBy("part").agg(F.count("*").alias("segments"), F.sum("docs").alias("docs"), F.sum("ids").alias("ids"))
    at, rows = 0, []
    for r in sorted(parts.collect()):  # one row for each write task
        rows.append((r["part"], r["segments"], r["docs"], r["ids"], at))
        at += r["ids"]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.json(f"{path}/manifest")
    return path


MANIFEST = "part long, segments long, docs long, ids long, start long"


def _segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(f"{path}/segments").select("content")


def _nothing() -> None:
    """Reading keeps no memo; taking its place drops that of the writer, whose words are not needed any more."""


def _contents(batch: pa.RecordBatch):
    """The files of a batch, without a copy."""
    for x in batch.column("content"):
        yield memoryview(x.as_buffer())


def read_token_file(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files alone; starts of the parts come
    from the manifest, a row for each write task."""
    start = {r["part"]: r["start"] for r in spark.read.schema(MANIFEST).json(f"{path}/manifest").collect()}
    bases = spark.sparkContext.broadcast(start)
    key_type = pa.string() if id_type == "string" else pa.int64()

    def run(batches):
        only_memo("token blocks", _nothing)
        for b in batches:
            for data in _contents(b):
                for at, h in headers(data):
                    ids, lengths, keys = decode_whole(data[at : at + h[-1]])
                    ends = np.cumsum(lengths.astype(np.int64))
                    starts = ends - lengths
                    raw = ids.astype("<u4")
                    crc = [zlib.crc32(raw[s:e]) for s, e in zip(starts.tolist(), ends.tolist())]
                    yield pa.RecordBatch.from_arrays([pa.array(keys, key_type), pa.array(starts + (bases.value[h[7]] + h[8])), pa.array(lengths.astype(np.int64)), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    rows = _segments(spark, path).mapInArrow(run, f"doc_id {'string' if id_type == 'string' else 'long'}, start long, n_tokens long, ids_crc32 long")
    return rows.withColumn("doc_id", F.col("doc_id").cast(id_type))


def token_output(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int | None = 2, id_col: str = "doc_id", text: str = "text", memo: int = MEMO) -> DataFrame:
    """Write the token file of docs (memo: words a worker keeps, which bounds its memory) and return the digest of each document as read back from it."""
    path = write_token_file(docs, None, tokenizer, end_id, id_col, text, memo=memo)
    return read_token_file(docs.sparkSession, path, docs.schema[id_col].dataType.simpleString())
