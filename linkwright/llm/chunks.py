"""Chunks: slabs of documents as rows, and packed exchanges of what numpy finds in them.

A chunk is one row: some documents' bytes, compressed, with their ids. Work that needs a value
from the whole corpus for each of a chunk's many small parts sends packed arrays by hash bucket, gets packed
answers back by chunk, and meets the chunk's text again by chunk. Chunks are written once in the
shared folder, so every pass sees the same ones even if executors are lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLAB_BYTES, cut, prepare, slabs

SCHEMA = "chunk bigint, ids array<bigint>, size bigint, words bigint, text binary, bounds binary"
#: Bytes of corpus text for which one bucket of an exchange stands.
BUCKET_BYTES = 12 << 20


def chunked(docs: DataFrame, limit: int = SLAB_BYTES, level: int = 6) -> DataFrame:
    """``docs`` (doc_id, text; null texts are empty) as a written table of chunks of up to ``limit`` bytes
    (a longer text is a chunk of its own)."""
    prepare(docs.sparkSession)

    def run(batches):
        at = TaskContext.get().partitionId() << 33
        pack = zstandard.ZstdCompressor(level=level)

        def made(ids, parts, ends):
            data, offsets = np.concatenate(parts), np.concatenate([np.zeros(1, np.int64), *ends])
            words = len(word_bounds(data, offsets)[0])
            return pa.RecordBatch.from_arrays(
                [pa.array([at]), pa.array([ids], pa.list_(pa.int64())), pa.array([len(data)]), pa.array([words]), pa.array([pack.compress(data.tobytes())], pa.binary()), pa.array([offsets.tobytes()], pa.binary())],
                names=["chunk", "ids", "size", "words", "text", "bounds"],
            )

        ids, parts, ends, size = [], [], [], 0
        for batch, data, offsets in slabs(batches, limit=min(limit, SLAB_BYTES)):
            if ids and size + len(data) > limit:
                yield made(ids, parts, ends)
                at += 1
                ids, parts, ends, size = [], [], [], 0
            ids += batch.column(0).to_pylist()
            parts.append(data.copy())
            ends.append(offsets[1:] + size)
            size += len(data)
        if ids:
            yield made(ids, parts, ends)

    return cut(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("body")).mapInArrow(run, SCHEMA))


_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs without ASCII white space; runs do not cross rows."""
    gap = np.ones(len(data) + 2, bool)
    gap[1:-1] = _SPACE[data]
    first, last = ~gap[1:-1] & gap[:-2], ~gap[1:-1] & gap[2:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    first[inner] = ~gap[1:-1][inner]
    last[inner - 1] = ~gap[1:-1][inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def unpack(text: bytes, bounds: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(text), np.uint8), np.frombuffer(bounds, np.int64)


def bucket_bits(chunks: DataFrame, per_bucket: int = BUCKET_BYTES) -> int:
    """How many leading hash bits name a bucket, from the corpus's size."""
    total = chunks.agg(F.sum("size").alias("n")).first()["n"] or 0
    return max(3, int(total // per_bucket).bit_length())


def by_bucket(hashes: np.ndarray, bits: int):
    """(bucket, from, to) for sorted ``hashes``."""
    names = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.r_[True, names[1:] != names[:-1]]) if len(names) else np.zeros(0, np.int64)
    return zip(names[cuts].tolist(), cuts.tolist(), np.r_[cuts[1:], len(names)].tolist())


def meet(chunks: DataFrame, answers: DataFrame, run, schema: str) -> DataFrame:
    """``run`` (chunk's table) over each chunk's text and the answers for it. ``answers``: chunk,
    bucket, n, p, q."""
    null = lambda kind: F.lit(None).cast(kind)
    left = chunks.select("chunk", F.lit(-1).cast("bigint").alias("bucket"), F.lit(0).cast("bigint").alias("n"), "ids", F.col("text").alias("p"), F.col("bounds").alias("q"))
    right = answers.select("chunk", "bucket", "n", null("array<bigint>").alias("ids"), "p", "q" if "q" in answers.columns else null("binary").alias("q"))
    return left.unionByName(right).groupBy("chunk").applyInArrow(run, schema)


def split_chunk(t: pa.Table):
    """ids, bytes and offsets of the chunk, and the order of its answers by bucket."""
    bucket = t["bucket"].to_pylist()
    own = bucket.index(-1)
    order = sorted((i for i in range(len(bucket)) if i != own), key=lambda i: bucket[i])
    ids = t["ids"][own].as_py()
    data, offsets = unpack(t["p"][own].as_py(), t["q"][own].as_py())
    return ids, data, offsets, order


def frombytes(column, kind) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in column.to_pylist()]


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All of start .. start + size - 1, one range after the other."""
    total = int(sizes.sum())
    out = np.arange(total, dtype=np.int64)
    return out + np.repeat(starts - np.r_[0, np.cumsum(sizes)[:-1]], sizes) if total else out
