"""Benchmark decontamination: word windows of test items against all documents.

A broadcast, sorted hash set of the items' windows is probed by every window of every
document; each hit is verified word by word. The set is built in blocks whose size is
checked first, so what is broadcast never exceeds ``block_bytes`` whatever the benchmark holds.

Nulls and texts without words: no windows, not contaminated. Repeated rows are treated row by
row. Empty tables: no rows, or no hits. Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, prepare, shielded, slabs, span_hashes, table

WINDOW = 10
#: Bytes of benchmark text in one broadcast block.
BLOCK_BYTES = 16 << 20

# A-Z become a-z; digits, letters and every byte from 0x80 on are parts of words.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def words_of(data: np.ndarray, offsets: np.ndarray):
    """Lower-cased bytes, and start, end and row of each word; words never cross rows."""
    low = _LOWER[data]
    n = len(low)
    is_word = np.zeros(n + 2, bool)
    is_word[1:-1] = _WORD[low]
    first = is_word[1:-1] & ~is_word[:-2]
    last = is_word[1:-1] & ~is_word[2:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    first[inner] = is_word[1:-1][inner]
    last[inner - 1] = is_word[1:-1][inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return low, starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def _window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, from the words' hashes."""
    h = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        h = h * np.uint64(0x9FB21C651E98DF25) + words[k : k + len(h)]
    return h


def _index(items: list[tuple]) -> dict:
    """windows by length: sorted hashes, and for each the windows (words, item_id) that have it."""
    by: dict[int, dict[int, list]] = {}
    for item, body in items:
        data = np.frombuffer(body, np.uint8)
        low, starts, ends, _ = words_of(data, np.array([0, len(data)], np.int64))
        if not len(starts):
            continue
        size = min(WINDOW, len(starts))
        h = _window_hashes(span_hashes(low, starts, ends), size)
        raw = low.tobytes()
        words = [raw[a:b] for a, b in zip(starts, ends)]
        for i, x in enumerate(h.tolist()):
            by.setdefault(size, {}).setdefault(x, []).append((b" ".join(words[i : i + size]), item))
    out = {}
    for size, found in by.items():
        keys = np.array(sorted(found), np.uint64)
        bits = np.zeros(1 << 20, bool)
        bits[(keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        out[size] = (keys, bits, [found[k] for k in keys.tolist()])
    return out


def _hits(index: dict, data: np.ndarray, offsets: np.ndarray):
    """Words' bounds and rows, which words are hit, and (row, item) pairs."""
    low, starts, ends, row = words_of(data, offsets)
    hit = np.zeros(len(starts) + 1, np.int64)
    pairs = set()
    hashes = span_hashes(low, starts, ends) if index and len(starts) else np.zeros(0, np.uint64)
    for size, (keys, bits, known) in index.items():
        h = _window_hashes(hashes, size)
        if not len(h):
            continue
        at = np.flatnonzero(bits[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
        at = at[row[at] == row[at + size - 1]]
        k = np.minimum(np.searchsorted(keys, h[at]), len(keys) - 1)
        same = keys[k] == h[at]
        for i, j in zip(at[same].tolist(), k[same].tolist()):
            here = b" ".join(low[a:b].tobytes() for a, b in zip(starts[i : i + size], ends[i : i + size]))
            items = [item for words, item in known[j] if words == here]
            if items:
                hit[i] += 1
                hit[i + size] -= 1
                pairs.update((int(row[i]), item) for item in items)
    return starts, ends, row, np.cumsum(hit[:-1]) > 0, pairs


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> list[DataFrame]:
    """The items dealt into blocks of about ``block_bytes``, by the checked size of the table."""
    size = benchmark.select(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    n = int(size // block_bytes) + 1
    if n == 1:
        return [benchmark]
    return [benchmark.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == i) for i in range(n)]


def find_hits(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, runs (array of hit byte ranges [start, end)), hit_words (array of hit word
    ordinals as ranges), items (array of item_id as strings): one row for each row of ``docs``.

    ``docs`` needs doc_id and text. With more than one block the blocks' rows are merged by row."""
    spark = docs.sparkSession
    prepare(spark)
    schema = "_row bigint, doc_id bigint, n_words bigint, word_starts array<bigint>, word_ends array<bigint>, byte_starts array<bigint>, byte_ends array<bigint>, items array<string>"
    blocks = benchmark_blocks(benchmark.select("item_id", "text"), block_bytes)
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("body"))
    if len(blocks) > 1:  # each block sees the same row numbers
        rows = cut(rows)
    parts = []
    for block in blocks:
        items = [(str(r["item_id"]), bytes(r["body"])) for r in block.where("text is not null").select("item_id", F.col("text").cast("binary").alias("body")).collect()]
        shared = spark.sparkContext.broadcast(_index(items))

        def scan(batches, shared=shared):
            index = shared.value
            for batch, data, offsets in slabs(batches):
                starts, ends, row, hit, pairs = _hits(index, data, offsets)
                n = batch.num_rows
                first = np.searchsorted(row, np.arange(n + 1))
                out = {k: [[] for _ in range(n)] for k in ("word_starts", "word_ends", "byte_starts", "byte_ends")}
                if hit.any():
                    new = np.r_[True, row[1:] != row[:-1]]
                    begin = np.flatnonzero(hit & (new | ~np.r_[False, hit[:-1]]))
                    end = np.flatnonzero(hit & (np.r_[new[1:], True] | ~np.r_[hit[1:], False]))
                    for a, b in zip(begin.tolist(), end.tolist()):
                        r = int(row[a])
                        out["word_starts"][r].append(a - int(first[r]))
                        out["word_ends"][r].append(b + 1 - int(first[r]))
                        out["byte_starts"][r].append(int(starts[a] - offsets[r]))
                        out["byte_ends"][r].append(int(ends[b] - offsets[r]))
                items = [[] for _ in range(n)]
                for r, item in pairs:
                    items[r].append(item)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(np.diff(first), pa.int64()), *(pa.array(out[k], pa.list_(pa.int64())) for k in ("word_starts", "word_ends", "byte_starts", "byte_ends")), pa.array([sorted(set(x)) for x in items], pa.list_(pa.string()))],
                    ["_row", "doc_id", "n_words", "word_starts", "word_ends", "byte_starts", "byte_ends", "items"],
                )

        parts.append(rows.mapInArrow(scan, schema))
    if len(parts) == 1:
        return parts[0].drop("_row")
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("word_starts", "word_ends", "byte_starts", "byte_ends")]
    return union.groupBy("_row", "doc_id", "n_words").agg(*lists, F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")).drop("_row")


def report(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: word count, hit words (each counted once), items and their digest."""
    hits = find_hits(docs, benchmark, block_bytes)
    # Ranges may overlap only between blocks; count the covered words exactly.
    spans = F.array_sort(F.arrays_zip("word_starts", "word_ends"))
    covered = F.aggregate(
        spans,
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("upto")),
        lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0).cast("bigint"), x["word_ends"] - F.greatest(a["upto"], x["word_starts"]))).alias("n"), F.greatest(a["upto"], x["word_ends"]).alias("upto")),
    )["n"]
    return hits.select(
        "doc_id",
        "n_words",
        covered.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("word_starts") > 0).alias("contaminated"),
    )


def _without(rest: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, words: tuple, hit: np.ndarray, max_share: float) -> pa.RecordBatch:
    """``rest`` (whose texts are ``data``) without its hit words; ``words``: starts, ends and rows."""
    starts, ends, row = words
    names = rest.schema.names
    total = np.bincount(row, minlength=rest.num_rows)
    bad = np.bincount(row[hit], minlength=rest.num_rows)
    keep = bad <= max_share * total
    # from the first byte of a hit run's first word to the last of its last word
    depth = np.zeros(len(data) + 1, np.int8)
    same = hit[1:] & hit[:-1] & (row[1:] == row[:-1])
    begin = np.flatnonzero(hit & ~np.r_[False, same])
    end = np.flatnonzero(hit & ~np.r_[same, False])
    depth[starts[begin]] += 1
    depth[ends[end]] -= 1
    cutout = np.cumsum(depth[:-1]) > 0
    text = rest.column(names.index("text")).to_pylist()
    size = rest.column(names.index("n_chars")).to_pylist() if "n_chars" in names else None
    for r in np.flatnonzero(bad > 0).tolist():
        part = data[offsets[r] : offsets[r + 1]]
        text[r] = part[~cutout[offsets[r] : offsets[r + 1]]].tobytes().decode("utf-8", "replace")
        if size:
            size[r] = len(text[r])
    arrays = [pa.array(text, c.type) if n == "text" else pa.array(size, c.type) if n == "n_chars" else c for n, c in zip(names, rest.columns)]
    return pa.RecordBatch.from_arrays(arrays, names=names).filter(pa.array(keep))


def _shared_index(block: DataFrame):
    items = [(str(r["item_id"]), bytes(r["body"])) for r in block.where("text is not null").select("item_id", F.col("text").cast("binary").alias("body")).collect()]
    return block.sparkSession.sparkContext.broadcast(_index(items))


def remove_spans(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, max_share: float = 0.5) -> DataFrame:
    """``docs`` without the benchmark's passages: hit byte ranges are cut out of the text, and a
    document of whose words over ``max_share`` are hit goes as a whole. Columns stay; n_chars, if
    there, is set anew for changed texts. A document without hits is unchanged.

    With more than one block, each looks for hits in the uncut texts; the hits of all are merged by
    row before any is cut, so that the blocks' size does not change the result."""
    prepare(docs.sparkSession)
    blocks = benchmark_blocks(benchmark.select("item_id", "text"), block_bytes)
    names, docs = docs.columns, shielded(docs)
    columns, schema = docs.columns, docs.schema
    if len(blocks) == 1:
        shared = _shared_index(blocks[0])

        def scan(batches):
            for batch, data, offsets in slabs(batches, "_body"):
                *words, hit, _ = _hits(shared.value, data, offsets)
                rest = batch.select(columns)
                yield _without(rest, data, offsets, tuple(words), hit, max_share) if hit.any() else rest

        return docs.withColumn("_body", F.col("text").cast("binary")).mapInArrow(scan, schema).toDF(*names)

    rows = cut(docs.withColumn("_row", F.monotonically_increasing_id()))  # each block sees the same row numbers
    found = []
    for block in blocks:

        def find(batches, shared=_shared_index(block)):
            for batch, data, offsets in slabs(batches, "_body"):
                _, _, row, hit, _ = _hits(shared.value, data, offsets)
                if hit.any():
                    place = np.arange(len(row)) - np.searchsorted(row, row)
                    with_hits = np.unique(row[hit])
                    ordinals = np.split(place[hit], np.searchsorted(row[hit], with_hits)[1:])
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(with_hits)), pa.array(ordinals, pa.list_(pa.int64()))], names=["_row", "_words"])

        found.append(rows.select("_row", F.col("text").cast("binary").alias("_body")).mapInArrow(find, "_row bigint, _words array<bigint>"))
    merged = reduce(DataFrame.unionByName, found).groupBy("_row").agg(F.flatten(F.collect_list("_words")).alias("_words"))

    def apply(batches):
        for batch, data, offsets in slabs(batches, "_body"):
            rest, ordinals = batch.select(columns), batch.column(batch.schema.get_field_index("_words"))
            if ordinals.null_count == len(ordinals):
                yield rest
                continue
            _, starts, ends, row = words_of(data, offsets)
            first = np.searchsorted(row, np.arange(batch.num_rows))
            hit = np.zeros(len(row), bool)
            for r, places in enumerate(ordinals):
                if places.is_valid:
                    hit[first[r] + places.values.to_numpy()] = True
            yield _without(rest, data, offsets, (starts, ends, row), hit, max_share)

    joined = rows.join(cut(merged), "_row", "left").withColumn("_body", F.col("text").cast("binary"))
    return joined.mapInArrow(apply, schema).toDF(*names)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH b AS (
  SELECT item_id, w, least(10, len(w)) AS n
  FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark)
  WHERE len(w) > 0),
k AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS t FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
p AS (
  SELECT rid, n, i, array_to_string(w[i : i + n - 1], ' ') AS t
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM k) WHERE len(w) >= n)),
h AS (SELECT p.rid, p.i, p.n, k.item_id FROM p JOIN k ON p.n = k.n AND p.t = k.t),
hw AS (SELECT rid, count(DISTINCT x) AS c FROM (SELECT rid, unnest(range(i, i + n)) AS x FROM h) GROUP BY rid),
hi AS (SELECT rid, count(DISTINCT item_id) AS c, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s FROM h GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(hw.c, 0) AS n_hit, coalesce(hi.c, 0) AS n_items, sha256(coalesce(hi.s, '')) AS items_sha256, coalesce(hw.c, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (rid) LEFT JOIN hi USING (rid)
"""
