"""Byte-level BPE: ranked merges folded over the byte arrays of distinct words; exact decoding.

Each match of the splitting pattern is encoded by itself. The words of a slab are made distinct, and
those not met before are folded together with numpy: a word is a row of token ids, starting with its
bytes; each round looks every adjacent pair up in a literal table of ranked merges and joins, in each
row, the leftmost pair of lowest rank, until no row has a pair left. Decoding concatenates the
tokens' bytes.

A null text is an empty one (no tokens). A match of over ``LONG_WORD`` bytes is folded by itself in time n log n.
Repeated rows and empty tables are ordinary; extra columns are ignored. No special tokens: their strings are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare, slabs, table

#: Words whose codes a worker remembers; the memory is emptied when it is full.
REMEMBERED = 300_000

#: Bytes of a word from which on it is folded by itself, with a heap of its pairs.
LONG_WORD = 512

_loaded: dict = {}


def read_ranks(lines: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines.splitlines() if line.strip())}


class Merges:
    """A rank file as tables: tokens' bytes, the ids of single bytes, and ranked pairs of ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.pieces = {i: t for t, i in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs: dict[tuple[int, int], int] = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs[a, b] = rank
        self.pairs = pairs
        code = np.array([(a << 24) | b for a, b in pairs], np.int64)
        value = np.array(list(pairs.values()), np.int64)
        # open addressing over a power of two: one gather for most look-ups
        self.bits = 20
        while len(code) * 3 > 1 << self.bits:
            self.bits += 1
        size = 1 << self.bits
        self.keys, self.values = np.full(size, -1, np.int64), np.full(size, 1 << 40, np.int64)
        self.reach = 0
        left, slot = np.arange(len(code)), self._slot(code)
        while len(left):
            at = (slot[left] + self.reach) & (size - 1)
            free = self.keys[at] == -1
            at, who = at[free], left[free]
            at, first = np.unique(at, return_index=True)
            who = who[first]
            self.keys[at], self.values[at] = code[who], value[who]
            left = np.setdiff1d(left, who, assume_unique=True)
            self.reach += 1

    def _slot(self, code: np.ndarray) -> np.ndarray:
        return ((code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, or 1 << 40 where they never merge."""
        code = (left << 24) | right
        out = np.full(len(code), 1 << 40, np.int64)
        slot = self._slot(code)
        open_ = np.arange(len(code))
        for k in range(self.reach):
            at = (slot[open_] + k) & (len(self.keys) - 1)
            held = self.keys[at]
            same = held == code[open_]
            out[open_[same]] = self.values[at[same]]
            open_ = open_[~same & (held != -1)]
            if not len(open_):
                break
        return out

    def fold(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word."""
        out: list = [None] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        long_ = int(np.searchsorted(sizes[order], LONG_WORD))
        for i in order[long_:].tolist():
            out[i] = self._fold_long(words[i])
        order, at = order[:long_], 0
        while at < len(order):  # rows of like width, so that padding stays small
            width = max(int(sizes[order[at]]) * 5 // 4, 8)
            end = int(np.searchsorted(sizes[order], width, side="right"))
            end = min(max(end, at + 1), at + max(1, 2_000_000 // width))
            chosen = order[at:end]
            at = end
            self._fold([words[i] for i in chosen], sizes[chosen], chosen, out)
        return out

    def _fold_long(self, word: bytes) -> np.ndarray:
        """The same for one long word: pairs wait in a heap by rank, then place; parts are a linked list."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        first = self.rank(np.array(ids[:-1], np.int64), np.array(ids[1:], np.int64)).tolist()
        # an entry is stale if one of its parts has been joined since
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r < 1 << 40]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = r, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y < n:
                    low = self.pairs.get((ids[x], ids[y]))
                    if low is not None:
                        heapq.heappush(heap, (low, x, ids[x], ids[y]))
        return np.array([x for x in ids if x >= 0], np.int64)

    def _fold(self, words: list[bytes], sizes: np.ndarray, names: np.ndarray, out: list) -> None:
        n, width = len(words), int(sizes.max(initial=1))
        ids = np.full((n, width + 1), -1, np.int64)
        inside = np.arange(width)[None, :] < sizes[:, None]
        ids[:, :width][inside] = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        ranks = np.full((n, width), 1 << 40, np.int64)
        has = ids[:, 1:] >= 0
        ranks[has] = self.rank(ids[:, :-1][has], ids[:, 1:][has])
        names, sizes = names.copy(), sizes.copy()
        while len(names):
            best = ranks.argmin(axis=1)
            rows = np.arange(len(names))
            low = ranks[rows, best]
            done = low >= 1 << 40
            if done.any():
                for r in np.flatnonzero(done).tolist():
                    out[names[r]] = ids[r, : sizes[r]].copy()
                keep = ~done
                ids, ranks, names, sizes, best, low = ids[keep], ranks[keep], names[keep], sizes[keep], best[keep], low[keep]
                rows = np.arange(len(names))
                if not len(names):
                    break
            # join at best: later cells move one to the left
            width = ids.shape[1]
            cell = np.arange(width - 1)[None, :]
            moved = np.where(cell <= best[:, None], ids[:, :-1], ids[:, 1:])
            ids = np.concatenate([moved, np.full((len(names), 1), -1, np.int64)], axis=1)
            ids[rows, best] = low
            moved = np.where(cell[:, : width - 2] < best[:, None], ranks[:, :-1], ranks[:, 1:])
            ranks = np.concatenate([moved, np.full((len(names), 1), 1 << 40, np.int64)], axis=1)
            sizes -= 1
            for side in (-1, 0):
                p = best + side
                ok = (p >= 0) & (p + 1 < sizes)
                fresh = np.full(len(names), 1 << 40, np.int64)
                fresh[ok] = self.rank(ids[rows[ok], p[ok]], ids[rows[ok], p[ok] + 1])
                there = p >= 0
                ranks[rows[there], p[there]] = fresh[there]
            longest = int(sizes.max())
            if longest + 2 < width * 3 // 4:
                ids, ranks = ids[:, : longest + 1].copy(), ranks[:, :longest].copy()


def merges(key: str, lines: bytes) -> tuple[Merges, dict[str, str]]:
    """The tables of a rank file, made once in each worker, and the words it remembers."""
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = (Merges(read_ranks(lines)), {})
    return _loaded[key]


def encode_all(words: set[str], tables: Merges, memory: dict[str, str]) -> None:
    """Put the codes of ``words`` not in ``memory`` there, as decimal ids joined by commas."""
    new = [w for w in words if w not in memory]
    if len(memory) + len(new) > REMEMBERED:
        memory.clear()
        new = list(words)
    for w, ids in zip(new, tables.fold([w.encode("utf-8") for w in new])):
        memory[w] = ",".join(map(str, ids.tolist()))


def encode(docs: DataFrame, ranks: bytes, pattern: str, digests: bool = False) -> DataFrame:
    """doc_id and tokens (array of ids); or, with ``digests``, doc_id, n_tokens, ids_sha256 and
    decoded_sha256 of the decoded bytes."""
    spark = docs.sparkSession
    prepare(spark)
    key = hashlib.sha256(ranks).hexdigest()
    shared = spark.sparkContext.broadcast(ranks)  # a rank file: a megabyte or so
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" if digests else "doc_id bigint, tokens array<int>"

    def run(batches):
        tables, memory = merges(key, shared.value)
        pieces = {str(i): t for i, t in tables.pieces.items()}
        match = regex.compile(pattern).findall
        for batch, data, offsets in slabs(batches):
            raw = data.tobytes()
            texts = [match(raw[a:b].decode("utf-8", "replace")) for a, b in zip(offsets, offsets[1:])]
            encode_all(set().union(*texts), tables, memory)
            joined = [",".join([memory[w] for w in words]) for words in texts]
            if digests:
                rows = []
                for s in joined:
                    ids = s.split(",") if s else []
                    rows.append((len(ids), hashlib.sha256(s.encode()).hexdigest(), hashlib.sha256(b"".join([pieces[i] for i in ids])).hexdigest()))
                arrays = [pa.array(list(c), k) for c, k in zip(zip(*rows), (pa.int64(), pa.string(), pa.string()))]
                yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            else:
                tokens = [list(map(int, s.split(","))) if s else [] for s in joined]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tokens, pa.list_(pa.int32()))], names=["doc_id", "tokens"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("body")).mapInArrow(run, schema)


def fold_in_sql(words: DataFrame, ranks: bytes, word: str = "word", buckets: int = 1 << 14) -> DataFrame:
    """``words`` (distinct, binary column ``word``) with ``ids``: the same fold as Spark higher-order functions.

    A literal rank map of 50,000 entries is searched from end to end at each look-up, so the ranks are
    one literal array of small maps by hash. Even so the fold is interpreted, pair by pair; see the
    README for its cost. For vocabularies of words, not for whole corpora."""
    by: list[dict] = [{} for _ in range(buckets)]
    spark = words.sparkSession
    pieces = spark.createDataFrame([(t, i) for t, i in read_ranks(ranks).items()], "piece binary, rank int")
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")
    for r in pieces.select(place(F.col("piece")).alias("b"), "piece", "rank").collect():  # the rank file's rows
        by[r["b"]][r["piece"]] = r["rank"]
    literal = spark.createDataFrame([([list(m.items()) for m in by],)], "_ranks array<array<struct<p:binary,r:int>>>")
    literal = literal.select(F.transform("_ranks", lambda m: F.map_from_entries(m)).alias("_ranks"))
    rank = lambda piece: F.element_at(F.col("_ranks"), place(piece) + 1)[piece]
    start = F.transform(F.sequence(F.lit(1), F.octet_length(word)), lambda i: F.substring(F.col(word), i, F.lit(1)))

    def merge(parts, _):
        found = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: rank(F.concat(F.element_at(parts, i), F.element_at(parts, i + 1))))
        at = F.array_position(found, F.array_min(found)).cast("int")
        joined = F.concat(F.slice(parts, F.lit(1), at - 1), F.array(F.concat(F.element_at(parts, at), F.element_at(parts, at + 1))), F.slice(parts, at + 2, F.size(parts)))
        return F.when((F.size(parts) < 2) | F.coalesce(F.array_min(found).isNull(), F.lit(True)), parts).otherwise(joined)

    turns = F.sequence(F.lit(1), F.greatest(F.octet_length(word) - 1, F.lit(1)))
    # a sequence from 1 to 0 counts down: an empty word has no parts
    parts = F.when(F.octet_length(word) > 0, F.aggregate(turns, start, merge)).otherwise(F.array().cast("array<binary>"))
    folded = words.crossJoin(F.broadcast(literal)).withColumn("_parts", parts)
    return folded.withColumn("ids", F.transform("_parts", rank)).drop("_parts", "_ranks")


def decode(df: DataFrame, ranks: bytes, tokens: str = "tokens", out: str = "decoded") -> DataFrame:
    """``df`` with the binary column ``out`` (in place of any of that name): the tokens' pieces, concatenated.

    The pieces are one literal array, by id; they are joined as hexadecimal digits, since Spark joins arrays
    of strings in linear time. Null tokens give null, no tokens nothing; null and unknown ids have no piece."""
    pieces = {i: t for t, i in read_ranks(ranks).items()}
    spark = df.sparkSession
    literal = spark.createDataFrame([([pieces.get(i, b"").hex().upper() for i in range(max(pieces) + 1)],)], "_pieces array<string>")
    digits = F.transform(tokens, lambda t: F.when((t >= 0) & (t < F.size("_pieces")), F.get("_pieces", t)))
    joined = df.drop(out).crossJoin(F.broadcast(literal))
    return joined.withColumn(out, F.unhex(F.array_join(digits, ""))).drop("_pieces")


def _public(name: str) -> tuple[bytes, str]:
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read(), public_tokenizers.PATTERN


def op10_bpe(spark: SparkSession, sf_dir: str, vocabulary: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    ranks, pattern = _public(vocabulary)
    return encode(table(spark, sf_dir, "documents"), ranks, pattern, digests=True)
