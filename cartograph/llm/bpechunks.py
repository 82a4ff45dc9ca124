"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over a text's bytes sets cut points that depend on the content alone, so documents
that share a passage share its chunks.  Chunk digests are counted over all documents; chunks met
twice or more are encoded once, in a dictionary table, and joined back to the documents that hold
them; all other chunks are encoded where they stand.  A document's ids are its chunks' ids in
order, with every join repaired: the words around it are encoded again across the join, over a
window that doubles until its ids agree with the chunk ids on both sides (at last the whole text).
A document with a join that the narrowest window doesn't settle is finished where it is scanned; for
the others ids of their own chunks and digests of the shared ones are all that is kept, never the text.

Which chunks may be shared is passed to the second scan as a bitmap of fixed size (SHARED_BITS,
whatever the data's size): a stray bit only sends a chunk to the dictionary needlessly.

Defined results: a null text is the empty text (no ids, empty decoded text); repeated rows and ids
stay rows of their own; an empty table gives no rows; extra columns are ignored; a text without
white space is one chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartograph.llm.wordbpe import ODD_SPACE, WordBpe, word_bpe
from cartograph.session import materialize

STEPS = (1, 2, 4, 8)
ROLL = 16  # bytes the rolling hash sees: 1 + sum(STEPS)
CUT_BITS = 9  # a cut every 2 ** CUT_BITS bytes on average
SHARED_BITS = 1 << 25  # 4 MB
SENT = 1_000_000  # digests of a task whose chunk it remembers to have passed on
JOIN_WORDS = 1  # words on either side of a join that are encoded again first

_rng = np.random.default_rng(20_240_607)
GEAR = _rng.integers(0, 2 ** 32, 256, dtype=np.uint32)


def cut_points(raw: bytes) -> np.ndarray:
    """Ends of all chunks but the last: just past the first white space (space, line feed) after each hit."""
    if len(raw) <= ROLL:
        return np.zeros(0, np.int64)
    b = np.frombuffer(raw, np.uint8)
    g = GEAR[b]
    h = g
    for k in STEPS:  # h[i] = sum of g[i - j] << j over ROLL bytes, doubled span by span
        h = h[k:] + (h[:-k] << np.uint32(k))
    # h[0] stands for byte ROLL - 1
    hits = np.flatnonzero((h >> np.uint32(32 - CUT_BITS)) == 0) + ROLL - 1
    if not len(hits):
        return np.zeros(0, np.int64)
    gaps = np.flatnonzero((b == 32) | (b == 10))
    at = np.searchsorted(gaps, hits)
    ends = np.unique(gaps[at[at < len(gaps)]]) + 1
    return ends[ends < len(raw)]


def chunks(text: str) -> list[bytes]:
    """Chunks (UTF-8) of a text; they join to it."""
    raw = text.encode("utf-8")
    edges = [0, *cut_points(raw).tolist(), len(raw)]
    return [raw[a:b] for a, b in zip(edges, edges[1:]) if b > a]


def digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def short(d: bytes) -> int:
    """64 bits of a digest, for counting."""
    return int.from_bytes(d[:8], "little", signed=True)


def spot(d: bytes) -> int:
    return short(d) % SHARED_BITS


def shared_bitmap(docs: DataFrame) -> bytes:
    """Bitmap of the digests that occur twice or more among all documents' chunks."""

    @F.pandas_udf("array<long>")
    def marks(texts: pd.Series) -> pd.Series:
        return pd.Series([[short(digest(c)) for c in chunks(t)] if t else [] for t in texts])

    twice = (docs.select(F.explode(marks("text")).alias("mark")).groupBy("mark").agg(F.count("*").alias("n"))
             .where("n > 1").select(F.pmod("mark", F.lit(SHARED_BITS)).alias("spot")).distinct())
    # the bitmap is built in fixed-size pieces where the spots land: SHARED_BITS / 8 bytes in all
    piece = 1 << 16

    def pieces(batches):
        for batch in batches:
            for p, found in zip(batch.column("piece").to_pylist(), batch.column("spots")):
                bits = np.zeros(piece, np.uint8)
                bits[np.asarray(found.values)] = 1
                yield pa.RecordBatch.from_pydict({"piece": [p], "bits": [np.packbits(bits).tobytes()]},
                                                 schema=pa.schema([("piece", pa.int32()), ("bits", pa.binary())]))

    rows = (twice.groupBy(F.expr(f"spot div {piece}").cast("int").alias("piece"))
            .agg(F.collect_list(F.expr(f"spot % {piece}")).alias("spots")).mapInArrow(pieces, "piece int, bits binary"))
    bitmap = np.zeros(SHARED_BITS // 8, np.uint8)
    for r in rows.toLocalIterator():
        bitmap[r["piece"] * piece // 8:(r["piece"] + 1) * piece // 8] = np.frombuffer(r["bits"], np.uint8)
    return bitmap.tobytes()


def narrow(ids: bytes) -> bytes:
    """Packed ids with two bytes each where all are below 2^16, behind a byte that names the size."""
    wide_ids = np.frombuffer(ids, "<u4")
    return b"\x02" + wide_ids.astype("<u2").tobytes() if wide_ids.max(initial=0) < 1 << 16 else b"\x04" + ids


def wide(ids: bytes) -> bytes:
    return ids[1:] if ids[0] == 4 else np.frombuffer(ids, "<u2", offset=1).astype("<u4").tobytes()


def windows(left: bytes, right: bytes, n: int, bpe: WordBpe) -> tuple[bytes, bytes, bytes]:
    """Ids of the last ``n`` words of ``left``, of the first ``n`` of ``right``, and of both across the join."""
    a, b = left.rsplit(None, n)[-n:], right.split(None, n)[:n]
    a, b = b" ".join(a).decode("utf-8", "replace"), b" ".join(b).decode("utf-8", "replace")
    return bpe.encode(a), bpe.encode(b), bpe.encode_whole(a + left[len(left.rstrip()):].decode("utf-8") + b)


def agree(left: bytes, right: bytes, bpe: WordBpe) -> bool:
    """Whether the narrowest window settles a join.

    The ids of a chunk without odd white space are those of its words in order, so they begin and
    end with the ids of its first and last words.
    """
    tail, head, across = windows(left, right, JOIN_WORDS, bpe)
    return across == tail + head


def join_ids(parts: list[tuple[bytes, bytes]], bpe: WordBpe) -> bytes:
    """Ids of a text from (chunk, ids) parts, every join repaired until it agrees exactly."""
    if not parts:
        return b""
    out = [parts[0][1]]
    for (left, left_ids), (right, right_ids) in zip(parts, parts[1:]):
        n = JOIN_WORDS
        while True:
            tail, head, across = windows(left, right, n, bpe)
            if left_ids.endswith(tail) and right_ids.startswith(head) and across == tail + head:
                out.append(right_ids)
                break
            if n >= max(len(left.split()), len(right.split())):
                return bpe.encode_whole(b"".join(c for c, _ in parts).decode("utf-8"))
            n *= 2
    return b"".join(out)


RESULT = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]


def finish(ids: bytes, bpe: WordBpe) -> tuple[int, str, str]:
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(bpe.decode(ids).encode("utf-8")).hexdigest()


def encode(docs: DataFrame, tokenizer_path: str, keep: list[str] = (), ids: bool = False) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 (and ``ids`` as an int array) of every row, with columns ``keep``.

    Rows without shared chunks are finished in the scan; the others wait, as one table, for the
    dictionary of shared chunks.
    """
    spark = docs.sparkSession
    texts = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce("text", F.lit("")).alias("__text"))
    bitmap = spark.sparkContext.broadcast(shared_bitmap(texts.select(F.col("__text").alias("text"))))
    out_type = ("struct<n:long,ids:string,decoded:string,raw:binary,"
                "parts:array<struct<pos:int,own:binary,digest:binary,chunk:binary>>>")

    @F.pandas_udf(out_type)
    def scan(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bits, bpe, sent = np.frombuffer(bitmap.value, np.uint8), word_bpe(tokenizer_path), set()
        for series in parts:
            rows = []
            for text in series:
                cut = chunks(text)
                marks = [digest(c) for c in cut]
                shared = [bool(bits[(s := spot(d)) >> 3] >> (7 - (s & 7)) & 1) for d in marks]
                if any(shared) and not ODD_SPACE.search(text) and all(agree(a, b, bpe) for a, b in zip(cut, cut[1:])):
                    if len(sent) > SENT:
                        sent.clear()
                    # a shared chunk's bytes leave the task once, for the dictionary
                    rows.append((None, None, None, None, [
                        (i, None, d, None if d in sent or sent.add(d) else c) if known else (i, narrow(bpe.encode(c.decode("utf-8"))), None, None)
                        for i, (c, d, known) in enumerate(zip(cut, marks, shared))]))
                else:
                    got = join_ids([(c, bpe.encode(c.decode("utf-8"))) for c in cut], bpe)
                    rows.append((*finish(got, bpe), got if ids else None, []))
            yield pd.DataFrame(rows, columns=["n", "ids", "decoded", "raw", "parts"])

    scanned = texts.withColumn("__s", scan("__text")).drop("__text").withColumn("__row", F.monotonically_increasing_id())
    scanned = materialize(scanned, "bpe-scan")
    waiting = scanned.where("__s.n is null")
    refs = waiting.select("__row", F.explode("__s.parts").alias("c")).select("__row", "c.*").where("digest is not null")

    @F.pandas_udf("binary")
    def encode_chunk(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = word_bpe(tokenizer_path)
        for series in parts:
            yield pd.Series([narrow(bpe.encode(c.decode("utf-8"))) for c in series])

    first = refs.where("chunk is not null").groupBy("digest").agg(F.any_value("chunk").alias("chunk"))
    dictionary = materialize(first.select("digest", encode_chunk("chunk").alias("chunk_ids")), "bpe-dictionary")
    per_doc = (refs.select("__row", "pos", "digest").join(dictionary, "digest")
               .groupBy("__row").agg(F.collect_list(F.struct("pos", "chunk_ids")).alias("known")))

    @F.pandas_udf("struct<n:long,ids:string,decoded:string,raw:binary>")
    def assemble(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        bpe = word_bpe(tokenizer_path)
        for owns, knowns in parts:
            rows = []
            for own, known in zip(owns, knowns):
                table = {k["pos"]: k["chunk_ids"] for k in known}
                got = b"".join(wide(table[i] if c is None else c) for i, c in enumerate(own))
                rows.append((*finish(got, bpe), got if ids else None))
            yield pd.DataFrame(rows, columns=["n", "ids", "decoded", "raw"])

    cols = [F.col(f"`{c}`") for c in keep]

    def shown(c):
        return [*cols, F.col(f"{c}.n").alias("n_tokens"), F.col(f"{c}.ids").alias("ids_sha256"),
                F.col(f"{c}.decoded").alias("decoded_sha256"), *([F.col(f"{c}.raw").alias("ids")] if ids else [])]

    done = scanned.where("__s.n is not null").select(*shown("__s"))
    own = F.transform("__s.parts", lambda x: x["own"])
    later = (waiting.select(*cols, "__row", own.alias("__own")).join(per_doc, "__row")
             .withColumn("__a", assemble("__own", "known")).select(*shown("__a")))
    return done.unionByName(later)
