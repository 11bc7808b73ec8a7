"""SimHash near-duplicates: 64-bit fingerprints, pigeonhole blocks, exact Hamming check, classes.

Fingerprints. Words are separated by ASCII white space, A-Z lower-cased; shingles of ``shingle``
words, repeats included (a shorter text is one shingle; a text without words has fingerprint zero).
A bit is 1 if it is set in over half of the shingles' XXH64 (seed 42).

Links. Equal fingerprints form one class; only distinct ones are compared. A fingerprint is split
into 2 + ``distance`` equal blocks, so two within ``distance`` bits agree in at least two of them;
each pair of blocks is a join key. A key shared by at most ``PAIR_LIMIT`` fingerprints is joined with
itself. A key shared by more is a star join instead: within such a group, fingerprints within 2 bits
share a 0- or 1-bit neighbour, so all that touch a neighbour are linked to the smallest of
them (nothing is left out, and no group emits all its pairs). Components come from large-star /
small-star rounds over written tables.

Null texts are empty texts. Repeated doc_ids: the rows keep their fingerprints, and a class takes the
smallest doc_id. Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, prepare, salted_join, slabs, table

SHINGLE = 3
DISTANCE = 2
PAIR_LIMIT = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, size: int):
    """XXH64 (seed 42) of every shingle of every row, and how many each row has."""
    n_rows = len(offsets) - 1
    hashes: list[int] = []
    counts = np.zeros(n_rows, np.int64)
    low = _LOWER[data].tobytes()
    digest = xxhash.xxh64_intdigest
    for r in range(n_rows):
        words = low[offsets[r] : offsets[r + 1]].split()
        n = len(words)
        if not n:
            continue
        text = b" ".join(words)
        if n <= size:
            hashes.append(digest(text, 42))
            counts[r] = 1
            continue
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.r_[0, ends[:-1] + 1]
        hashes += [digest(text[a:b], 42) for a, b in zip(starts[: n - size + 1].tolist(), ends[size - 1 :].tolist())]
        counts[r] = n - size + 1
    return np.array(hashes, np.uint64), counts


def fold(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprint of each row's run of hashes."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    begin = np.r_[0, np.cumsum(counts[full])[:-1]]
    half = counts[full]
    for byte in range(8):
        part = ((hashes >> np.uint64(8 * byte)) & np.uint64(255)).astype(np.uint8)
        ones = np.add.reduceat(np.unpackbits(part[:, None], axis=1, bitorder="little").astype(np.int32), begin, axis=0)
        bits = np.packbits(2 * ones > half[:, None], axis=1, bitorder="little")[:, 0]
        out[full] |= bits.astype(np.uint64) << np.uint64(8 * byte)
    return out


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a signed long), a row for each row of ``docs``."""
    prepare(docs.sparkSession)

    def run(batches):
        for batch, data, offsets in slabs(batches):
            fp = fold(*shingle_hashes(data, offsets, size))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("body")).mapInArrow(run, "doc_id bigint, fp bigint")


def block_keys(nodes: DataFrame, distance: int, agree: int = 2, blocks: int | None = None) -> DataFrame:
    """``nodes`` with k (which blocks) and v (their bits) for each choice of ``agree`` blocks."""
    blocks = blocks or distance + agree
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    keys = []
    for i, chosen in enumerate(combinations(range(blocks), agree)):
        mask = sum(masks[c] for c in chosen)
        mask -= (mask >> 63) << 64  # as a signed long
        keys.append(F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(mask)).alias("v")))
    return nodes.select("*", F.explode(F.array(*keys)).alias("_key")).select(*nodes.columns, "_key.k", "_key.v")


def links(nodes: DataFrame, distance: int = DISTANCE, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """(a, b), node ids, for every pair of distinct fingerprints within ``distance`` bits, or, within
    large groups, a star of such pairs that connects the same nodes. ``nodes``: node, fp (distinct)."""
    if distance > 2:
        raise ValueError("stars of large groups connect fingerprints within 2 bits")
    keyed = block_keys(nodes, distance)
    sizes = keyed.groupBy("k", "v").agg(F.count("*").alias("n")).where("n > 1")
    shared = cut(keyed.join(sizes, ["k", "v"]))
    few = shared.where(F.col("n") <= pair_limit)
    close = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= distance
    pairs = few.alias("a").join(few.alias("b"), [F.col("a.k") == F.col("b.k"), F.col("a.v") == F.col("b.v"), F.col("a.fp") < F.col("b.fp"), close]).select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))
    many = shared.where(F.col("n") > pair_limit).select("node", "fp").distinct()
    one_bit = [F.col("fp").bitwiseXOR(F.lit((1 << i) - ((1 << 64) if i == 63 else 0))) for i in range(64)]
    around = F.array(F.col("fp"), *(one_bit if distance else []))
    touched = many.select("node", F.explode(around).alias("at"))
    if distance == 2:
        hubs = touched.groupBy("at").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1").select("at", "hub")
    else:  # one bit apart: the neighbour is itself a fingerprint
        hubs = many.select(F.col("fp").alias("at"), F.col("node").alias("hub"))
    stars = salted_join(touched, hubs, "at").where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    return pairs.unionByName(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node of each component, by alternating large and small stars."""
    e = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    while True:
        # large star: each node's larger neighbours point to its smallest neighbour (or itself)
        both = e.select("u", "v").union(e.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = salted_join(both, low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = cut(large)
        # small star: each node's smaller neighbours, and itself, point to its smallest one
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = salted_join(large, low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        small = cut(small)
        now = small.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        was = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        e = small
        if now == was:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def cluster(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fp, component_id: a row for each row of ``docs``."""
    prints = cut(fingerprints(docs, size))
    nodes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("node")))
    roots = components(links(nodes.where("node is not null"), distance))
    named = nodes.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("component_id"))
    return salted_join(prints, named, "fp")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
