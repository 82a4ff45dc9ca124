"""Token-id files of patched frame-of-reference blocks.

File format (little-endian), one segment of whole documents per file row:

    magic "PFR1", u32 n_tokens, u32 n_blocks, u32 n_docs
    n_blocks x u32   block starts (byte offset of each block in the body): the index
    body             blocks of 128 ids (the last may be shorter):
                     u32 block minimum, u8 width, u8 number of exceptions, packed residuals
                     (``width`` bits each, most significant first, padded to a byte),
                     exceptions: u8 position and u32 residual each

A block subtracts its minimum and packs residuals at the width that holds PERCENTILE of them;
larger ones are zero in the packed part and stand in the exception list.  Block starts allow
reading any token range alone (``read_range``).

Texts are laid out by a range shuffle on doc_id, encoded where they land, and cut into segments at
document ends; segments, not tokens, carry the running offsets.

Defined results: a null text is the empty text (one id, the end id); null doc_ids come first;
repeated ids and rows are documents of their own; an empty table gives no rows; extra columns are
ignored.  A document of any length is one segment at least, never cut.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartograph.llm.common import width
from cartograph.session import materialize

MAGIC, BLOCK, PERCENTILE, END_ID = b"PFR1", 128, 0.9, 1
SEGMENT_TOKENS = 1 << 19
TEXTS = 256  # texts that a task turns to strings at once
SEGMENTS = "pid int, seq int, n_tokens long, payload binary, doc_ids array<long>, lengths array<int>"


def write_segment(ids: np.ndarray, n_docs: int = 0) -> bytes:
    """One segment of uint32 ids."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not blocks:
        return MAGIC + struct.pack("<III", 0, 0, n_docs)
    full = np.full(blocks * BLOCK, ids[-1], np.uint32)  # padding repeats the last id, cut off again on reading
    full[:n] = ids
    full = full.reshape(blocks, BLOCK)
    low = full.min(axis=1)
    res = full - low[:, None]
    nth = int(PERCENTILE * (BLOCK - 1))
    at = np.partition(res, nth, axis=1)[:, nth]
    widths = np.zeros(blocks, np.uint8)
    for b in range(32):
        widths[at >= np.uint32(1 << b)] = b + 1
    limits = np.array([(1 << w) - 1 for w in range(33)], np.uint32)[widths]
    odd = res > limits[:, None]
    n_odd = odd.sum(axis=1)
    sizes = 6 + widths.astype(np.int64) * (BLOCK // 8) + 5 * n_odd
    starts = np.cumsum(sizes) - sizes
    body = np.zeros(int(sizes.sum()), np.uint8)
    heads = np.zeros(blocks, np.dtype([("low", "<u4"), ("w", "u1"), ("n", "u1")]))
    heads["low"], heads["w"], heads["n"] = low, widths, n_odd
    body[starts[:, None] + np.arange(6)] = heads.view(np.uint8).reshape(blocks, 6)
    row, col = np.nonzero(odd)
    patch = np.zeros(len(row), np.dtype([("at", "u1"), ("v", "<u4")]))
    patch["at"], patch["v"] = col, res[row, col]
    spot = np.repeat(starts + sizes - 5 * n_odd, n_odd) + 5 * (np.arange(len(row)) - np.repeat(np.cumsum(n_odd) - n_odd, n_odd))
    body[spot[:, None] + np.arange(5)] = patch.view(np.uint8).reshape(-1, 5)
    res[odd] = 0
    for w in np.unique(widths[widths > 0]):
        rows = np.flatnonzero(widths == w)
        body[starts[rows][:, None] + 6 + np.arange(int(w) * BLOCK // 8)] = pack_bits(res[rows], int(w))
    return MAGIC + struct.pack("<III", n, blocks, n_docs) + starts.astype("<u4").tobytes() + body.tobytes()


def pack_bits(values: np.ndarray, w: int) -> np.ndarray:
    """Rows of BLOCK values as rows of w * BLOCK / 8 bytes."""
    if not w:
        return np.zeros((len(values), 0), np.uint8)
    size = 2 if w <= 16 else 4
    bits = np.unpackbits(values.astype(f">u{size}").view(np.uint8), axis=1).reshape(len(values), BLOCK, 8 * size)
    return np.packbits(bits[:, :, 8 * size - w:].reshape(len(values), BLOCK * w), axis=1)


def unpack_bits(packed: np.ndarray, w: int) -> np.ndarray:
    if not w:
        return np.zeros((len(packed), BLOCK), np.uint32)
    size = 2 if w <= 16 else 4
    bits = np.zeros((len(packed), BLOCK, 8 * size), np.uint8)
    bits[:, :, 8 * size - w:] = np.unpackbits(packed, axis=1).reshape(len(packed), BLOCK, w)
    return np.packbits(bits.reshape(len(packed), -1), axis=1).view(f">u{size}").astype(np.uint32)


def read_range(payload: bytes, first_block: int = 0, last_block: int | None = None) -> np.ndarray:
    """Ids of blocks first_block..last_block (exclusive; all if None), found by the index."""
    if payload[:4] != MAGIC:
        raise ValueError("not a token segment")
    n, blocks, _ = struct.unpack_from("<III", payload, 4)
    last_block = blocks if last_block is None else min(last_block, blocks)
    if first_block >= last_block:
        return np.zeros(0, np.uint32)
    raw = np.frombuffer(payload, np.uint8)
    body = 16 + 4 * blocks
    starts = np.frombuffer(payload, "<u4", blocks, 16)[first_block:last_block].astype(np.int64) + body
    head = raw[starts[:, None] + np.arange(6)]
    low = head[:, :4].copy().view("<u4").ravel()
    widths, odd = head[:, 4], head[:, 5].astype(np.int64)
    out = np.empty((len(starts), BLOCK), np.uint32)
    for w in np.unique(widths):
        rows = np.flatnonzero(widths == w)
        size = int(w) * BLOCK // 8
        out[rows] = unpack_bits(raw[starts[rows][:, None] + 6 + np.arange(size)], int(w))
    hot = np.flatnonzero(odd)
    if len(hot):
        counts = odd[hot]
        base = starts[hot] + 6 + widths[hot].astype(np.int64) * (BLOCK // 8)
        row = np.repeat(hot, counts)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        patch = raw[(np.repeat(base, counts) + 5 * nth)[:, None] + np.arange(5)]
        out[row, patch[:, 0]] = patch[:, 1:].copy().view("<u4").ravel()
    out += low[:, None]
    return out.ravel()[:min(n, last_block * BLOCK) - first_block * BLOCK]


def write_tokens(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Segments of all documents in ascending doc_id order, written to the shared folder and read back."""
    laid = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
            .repartitionByRange(width(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id")
            .withColumn("pid", F.spark_partition_id()))

    def encode(batches):
        from cartograph.llm.wordbpe import pack, word_bpe

        bpe, end = word_bpe(tokenizer_path), pack([end_id])
        ids, doc_ids, parts, size, seq, pid = [], [], [], 0, 0, 0

        def segment():
            payload = write_segment(np.frombuffer(b"".join(parts), "<u4"), len(ids))
            return pa.RecordBatch.from_pydict(
                {"pid": [pid], "seq": [seq], "n_tokens": [size], "payload": [payload], "doc_ids": [doc_ids],
                 "lengths": [ids]}, schema=SEGMENT_SCHEMA)

        for pid, doc_id, text in (row for batch in batches for a in range(0, batch.num_rows, TEXTS)
                                  for row in zip(*(batch.slice(a, TEXTS).column(c).to_pylist() for c in ("pid", "doc_id", "text")))):
            part = bpe.encode(text) + end
            parts.append(part)
            ids.append(len(part) // 4)
            doc_ids.append(doc_id)
            size += len(part) // 4
            if size >= SEGMENT_TOKENS:
                yield segment()
                ids, doc_ids, parts, size, seq = [], [], [], 0, seq + 1
        if ids:
            yield segment()

    return materialize(laid.mapInArrow(encode, SEGMENTS), "token-segments")


SEGMENT_SCHEMA = pa.schema([("pid", pa.int32()), ("seq", pa.int32()), ("n_tokens", pa.int64()), ("payload", pa.binary()),
                            ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32()))])


def read_tokens(segments: DataFrame) -> DataFrame:
    """Per document, from the segments' bytes: doc_id, start, n_tokens, ids_crc32."""

    def decode(batches):
        for batch in batches:
            for pid, seq, payload, doc_ids, lengths in zip(*(batch.column(c) for c in ("pid", "seq", "payload", "doc_ids", "lengths"))):
                data = read_range(payload.as_py()).astype("<u4").tobytes()
                sizes = np.array(lengths.as_py(), np.int64)
                ends = np.cumsum(sizes)
                crcs = [zlib.crc32(data[4 * (e - n):4 * e]) for e, n in zip(ends, sizes)]
                k = len(sizes)
                yield pa.RecordBatch.from_pydict(
                    {"pid": [pid.as_py()] * k, "seq": [seq.as_py()] * k, "doc_id": doc_ids.as_py(), "local": ends - sizes,
                     "n_tokens": sizes, "ids_crc32": crcs},
                    schema=pa.schema([("pid", pa.int32()), ("seq", pa.int32()), ("doc_id", pa.int64()), ("local", pa.int64()),
                                      ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]))

    docs = segments.select("pid", "seq", "payload", "doc_ids", "lengths").mapInArrow(
        decode, "pid int, seq int, doc_id long, local long, n_tokens long, ids_crc32 long")
    return (docs.join(offsets(segments), ["pid", "seq"])
            .select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"))


def offsets(segments: DataFrame) -> DataFrame:
    """Ids before each segment: sums over partitions (as many as files were laid out), then within."""
    sizes = segments.select("pid", "seq", "n_tokens")
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = sizes.groupBy("pid").agg(F.sum("n_tokens").alias("n")).select(
        "pid", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("pid_base"))
    own = Window.partitionBy("pid").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("own", F.coalesce(F.sum("n_tokens").over(own), F.lit(0))).join(whole, "pid") \
        .select("pid", "seq", (F.col("pid_base") + F.col("own")).alias("base"))
