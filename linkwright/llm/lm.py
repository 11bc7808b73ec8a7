"""Language-model scoring: stupid backoff with counts of the whole corpus, without the own document.

Words are separated by ASCII white space, A-Z lower-cased. n-grams of 1 to ``order`` words are counted
over all documents. Word i of a document scores, for the longest n of which the n-gram that ends there
occurs in other documents too (its context does as well, then),

    0.4 ** (order_here - n) * count(n-gram) / count(its first n - 1 words)      (n > 1)
    0.4 ** (order_here - 1) * count(word) / words of all other documents        (n = 1)
    0.4 ** order_here / (1 + words of all other documents)                      (seen nowhere else)

where counts leave the document itself out, and order_here = min(order, i). A document's score is the
sum of the logarithms (base 10).

Count tables are partitioned by the n-gram's hash: each chunk of documents sends its distinct n-grams
with their counts to the hash's bucket (pre-summed, so a hot n-gram is one entry per chunk), the
bucket sums them, and the sums return to the chunk's exploded n-grams, where they are joined by place
and summed per document. An n-gram is told by its bucket and 48 more bits of hash; these are sent sorted,
as differences.

A null text is empty, with no words and score 0. Repeated rows are documents of their own, so exact
copies see one another. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import bucket_bits, by_bucket, chunked, meet, split_chunk, unpack, word_bounds
from .common import mix, release, span_hashes, table

ORDER = 3
BACKOFF = 0.4
#: Bytes of text in a chunk: the more, the fewer n-grams are sent more than once.
CHUNK_BYTES = 6 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def grams(data: np.ndarray, offsets: np.ndarray, order: int):
    """Hash of the n-gram that ends at each word, for n = 1 .. order (0 where the text has fewer
    words before), and the row and ordinal of each word."""
    low = _LOWER[data]
    starts, ends = word_bounds(low, offsets)
    row = np.searchsorted(offsets, starts, side="right") - 1
    first = np.searchsorted(row, np.arange(len(offsets)))
    place = np.arange(len(row)) - first[row]
    word = span_hashes(low, starts, ends)
    out, h = [mix(word + np.uint64(1))], word
    for n in range(2, order + 1):
        # the n words that end here: the n - 1 that ended one before, and this one
        h = np.r_[np.zeros(1, np.uint64), mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n))] + word if len(word) else word
        out.append(np.where(place >= n - 1, mix(h), np.uint64(0)))
    return out, row, place


def _distinct(hashes: list[np.ndarray]):
    """All n-grams of a chunk, distinct and sorted, with counts, and each one's index by order."""
    flat = np.concatenate(hashes)
    u, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
    return u, np.split(inverse, len(hashes)), count


def _packed(sorted_keys: np.ndarray, pack: zstandard.ZstdCompressor) -> bytes:
    """Ascending 48-bit keys as differences: the low 32 bits of each, then the high 16, by bytes, compressed."""
    gaps = np.diff(sorted_keys, prepend=np.uint64(0))
    high = (gaps >> np.uint64(32)).astype("<u2").view(np.uint8)
    return gaps.astype("<u4").tobytes() + pack.compress(high[::2].tobytes() + high[1::2].tobytes())


def _unpacked(p: bytes, n: int, unzip: zstandard.ZstdDecompressor) -> np.ndarray:
    high = np.frombuffer(unzip.decompress(p[4 * n :]), np.uint8).astype(np.uint64)
    gaps = np.frombuffer(p, "<u4", n).astype(np.uint64) | (high[:n] << np.uint64(32)) | (high[n:] << np.uint64(40))
    return np.cumsum(gaps, dtype=np.uint64)


def _planes(counts: np.ndarray, pack: zstandard.ZstdCompressor) -> bytes:
    """Counts up to 2**32 byte by byte: all low bytes first, which are small and alike."""
    b = counts.astype("<u4").view(np.uint8).reshape(-1, 4)
    return b"".join([len(x).to_bytes(4, "little") + x for x in (pack.compress(b[:, i].tobytes()) for i in range(4))])


def _counts(p: bytes, n: int, unzip: zstandard.ZstdDecompressor) -> np.ndarray:
    out, at = np.zeros((n, 4), np.uint8), 0
    for i in range(4):
        size = int.from_bytes(p[at : at + 4], "little")
        out[:, i] = np.frombuffer(unzip.decompress(p[at + 4 : at + 4 + size], max_output_size=max(n, 1)), np.uint8)
        at += 4 + size
    return out.view("<u4")[:, 0].astype(np.int64)


def _send(chunks: DataFrame, bits: int, order: int) -> DataFrame:
    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for i in range(batch.num_rows):  # one by one: a chunk is large
                chunk, text, bounds = (batch.column(batch.schema.get_field_index(c))[i].as_py() for c in ("chunk", "text", "bounds"))
                hashes, _, _ = grams(*unpack(text, bounds), order)
                u, _, count = _distinct(hashes)
                rest = (u << np.uint64(bits)) >> np.uint64(16)
                rows = [(b, chunk, y - x, _packed(rest[x:y], pack), _planes(count[x:y], pack)) for b, x, y in by_bucket(u, bits)]
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=["bucket", "chunk", "n", "p", "q"])

    return chunks.mapInArrow(run, "bucket bigint, chunk bigint, n bigint, p binary, q binary")


def _sum(t: pa.Table) -> pa.Table:
    """In a bucket: how often each chunk's n-grams occur in other chunks."""
    sizes = t["n"].to_pylist()
    pack, unzip = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
    keys = np.concatenate([_unpacked(p, n, unzip) for p, n in zip(t["p"].to_pylist(), sizes)])
    count = np.concatenate([_counts(x, n, unzip) for x, n in zip(t["q"].to_pylist(), sizes)])
    by = np.argsort(keys, kind="stable")
    s = keys[by]
    head = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
    total = np.add.reduceat(count[by], head)
    others = np.empty(len(keys), np.int64)
    others[by] = np.repeat(total, np.diff(np.r_[head, len(by)])) - count[by]
    cuts = np.r_[0, np.cumsum(sizes)]
    return pa.table({"chunk": t["chunk"], "bucket": t["bucket"], "n": t["n"], "p": pa.array([_planes(others[a:b], pack) for a, b in zip(cuts, cuts[1:])], pa.binary())})


def _score(order: int, total: int):
    def run(t: pa.Table) -> pa.Table:
        ids, data, offsets, by = split_chunk(t)
        hashes, row, place = grams(data, offsets, order)
        n_rows = len(offsets) - 1
        words = np.bincount(row, minlength=n_rows)
        unzip = zstandard.ZstdDecompressor()
        sums = np.zeros(n_rows)
        if len(row):
            u, index, count = _distinct(hashes)
            corpus = count + np.concatenate([_counts(t["p"][i].as_py(), t["n"][i].as_py(), unzip) for i in by])
            left = []  # for each n, the count in other documents of the n-gram that ends at each word
            for k in index:
                pair = row.astype(np.int64) * len(u) + k
                _, inverse, own = np.unique(pair, return_inverse=True, return_counts=True)
                left.append(corpus[k] - own[inverse])
            # the context of an n-gram counts wherever it stands, also where nothing follows
            rest = (total - words)[row].astype(float)
            here = np.minimum(order, place + 1)
            value = np.where(left[0] > 0, BACKOFF ** (here - 1.0) * left[0] / np.maximum(rest, 1), BACKOFF ** (here * 1.0) / (1 + rest))
            for n in range(2, order + 1):
                before = np.r_[0, left[n - 2][:-1]]
                seen = (place >= n - 1) & (left[n - 1] > 0)
                value = np.where(seen, BACKOFF ** (here - float(n)) * left[n - 1] / np.maximum(before, 1), value)
            sums = np.bincount(row, np.log10(value), minlength=n_rows)
        release()
        mean = np.round(sums / np.maximum(words, 1), 6)
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(words, pa.int64()), "score": np.round(sums, 6), "mean_score": mean})

    return run


def score(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id, n_words, score, mean_score (by word; 0 for no words): a row for each row of ``docs``."""
    chunks = chunked(docs, CHUNK_BYTES, 9)
    bits = bucket_bits(chunks)
    total = chunks.agg(F.sum("words").alias("n")).first()["n"] or 0
    sums = _send(chunks, bits, order).groupBy("bucket").applyInArrow(_sum, "chunk bigint, bucket bigint, n bigint, p binary")
    return meet(chunks, sums, _score(order, total), "doc_id bigint, n_words bigint, score double, mean_score double")


def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
w AS (SELECT rid, unnest(words) AS g1, generate_subscripts(words, 1) AS i FROM d),
g AS (
  SELECT rid, i, g1, CASE WHEN i > 1 THEN p1 || ' ' || g1 END AS g2, CASE WHEN i > 2 THEN p2 || ' ' || p1 || ' ' || g1 END AS g3
  FROM (SELECT *, lag(g1, 1) OVER o AS p1, lag(g1, 2) OVER o AS p2 FROM w WINDOW o AS (PARTITION BY rid ORDER BY i))),
k AS (
  SELECT rid, i, n, t FROM (
    SELECT rid, i, 1 AS n, g1 AS t FROM g UNION ALL SELECT rid, i, 2, g2 FROM g WHERE g2 IS NOT NULL UNION ALL SELECT rid, i, 3, g3 FROM g WHERE g3 IS NOT NULL)),
corpus AS (SELECT n, t, count(*) AS c FROM k GROUP BY n, t),
own AS (SELECT rid, n, t, count(*) AS c FROM k GROUP BY rid, n, t),
others AS (SELECT o.rid, o.n, o.t, a.c - o.c AS c FROM own o JOIN corpus a ON o.n = a.n AND o.t = a.t),
l AS (
  SELECT k.rid, k.i, max(CASE WHEN k.n = 1 THEN o.c END) AS l1, coalesce(max(CASE WHEN k.n = 2 THEN o.c END), 0) AS l2, coalesce(max(CASE WHEN k.n = 3 THEN o.c END), 0) AS l3
  FROM k JOIN others o ON k.rid = o.rid AND k.n = o.n AND k.t = o.t GROUP BY k.rid, k.i),
b AS (
  SELECT *, lag(l1) OVER o AS b1, lag(l2) OVER o AS b2, least(3, i) AS here,
    (SELECT count(*) FROM w) - count(*) OVER (PARTITION BY rid) AS rest
  FROM l WINDOW o AS (PARTITION BY rid ORDER BY i)),
v AS (
  SELECT rid, count(*) AS n, sum(log10(CASE WHEN l3 > 0 THEN l3 / b2::DOUBLE WHEN l2 > 0 THEN pow(0.4, here - 2) * l2 / b1
    WHEN l1 > 0 THEN pow(0.4, here - 1) * l1 / greatest(rest, 1) ELSE pow(0.4, here) / (1 + rest) END)) AS s
  FROM b GROUP BY rid)
SELECT d.doc_id, CAST(coalesce(v.n, 0) AS BIGINT) AS n_words, round(coalesce(v.s, 0.0), 6) AS score, round(coalesce(v.s / v.n, 0.0), 6) AS mean_score
FROM d LEFT JOIN v ON d.rid = v.rid
"""
