"""Suffix sorting by a difference cover modulo 3, and removal of repeated byte strings with it.

``sort_suffixes`` is the difference-cover algorithm: triples at the sampled positions (1 and 2 modulo
3) are sorted and named, triples of names are sorted and named again until the names tell prefixes of
the wanted depth (or all apart), the other suffixes are sorted by their first letter and the name behind
it, and both are merged. A letter is the 8-byte string that begins at a position.

``remove_repeats`` removes every byte that a ``size``-byte string covers which also starts in a document
with a smaller doc_id. Its distribution:

1. Each string's anchor is its 24-byte substring of least hash (leftmost), so equal strings have equal
   anchors. Chunks send the hashes of their anchors by bucket; those of a single document in the
   whole corpus are discarded, as their strings cannot repeat. Four bytes of hash within a bucket can
   only keep too many, never too few.
2. The remaining runs of strings with one anchor go, with the text they cover, to their anchor's bucket,
   equal runs of a chunk as one with their smallest doc_id. So all strings that might be equal meet
   in one bucket, and a bucket stands for a fixed amount of text.
3. A bucket sorts its strings as suffixes of its own text by difference cover, and compares adjacent
   prefixes: strings of a group of equals whose doc_id is not the group's smallest are repeats.
4. Answers return to their chunks, which cut the covered bytes.

A null text is empty. A null doc_id is smaller than all others. Rows that share a doc_id do not
remove from one another. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from .chunks import bucket_bits, by_bucket, chunked, frombytes, meet, ranges, split_chunk, unpack
from .common import mix, release, rolling, span_hashes, table

SIZE = 50
ANCHOR = 24
_NULL = np.iinfo(np.int64).min


# --- the difference-cover algorithm -------------------------------------------------------------


def letters(text: np.ndarray, pad: int) -> np.ndarray:
    """For each position the 8 bytes from there on as one number; zeros follow the text."""
    n = len(text) + pad
    t = np.zeros(n + 8, np.uint8)
    t[: len(text)] = text
    w = np.empty(n, np.uint64)
    for a in range(0, n, 1 << 20):  # in pieces, so that no more than the result is large
        b = min(n, a + (1 << 20))
        piece = t[a : b + 7].astype(np.uint64)
        two = (piece[:-1] << np.uint64(8)) | piece[1:]
        four = (two[:-2] << np.uint64(16)) | two[2:]
        w[a:b] = (four[:-4] << np.uint64(32)) | four[4:]
    return w


def _name(at: np.ndarray, parts: list[np.ndarray], names: np.ndarray) -> int:
    """Sort the positions ``at`` by ``parts`` and write their dense ranks into ``names``."""
    order = np.lexsort(parts[::-1])
    new = np.zeros(len(at), bool)
    new[:1] = True
    for p in parts:
        s = p[order]
        new[1:] |= s[1:] != s[:-1]
    rank = np.cumsum(new)
    names[at[order]] = rank
    return int(rank[-1]) if len(rank) else 0


def sort_suffixes(text: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` ordered by the suffixes from there on, compared by ``depth`` bytes at least."""
    if len(starts) == 0:
        return starts
    pad = 3 * depth + 64
    w = letters(text, pad)
    limit = len(text) + pad - 24
    need = np.unique(np.concatenate([starts, starts + 1, starts + 2]))
    need = need[need % 3 != 0]
    # how far names must reach from the needed positions on
    covers, reach = [24], 24
    while reach < depth:
        step = min(2 * reach, -(-(depth - reach) // 3) * 3)
        covers.append((reach, step))
        reach = step + reach
    marked = [need]
    for first, second in reversed(covers[1:]):
        marked.append(np.unique(np.concatenate([marked[-1], marked[-1] + first, marked[-1] + second])))
        marked[-1] = marked[-1][marked[-1] < limit]
    names = np.zeros(limit + 4 * depth + 64, np.int64)
    at = marked.pop()
    count = _name(at, [w[at], w[at + 8], w[at + 16]], names)
    for first, second in covers[1:]:  # recursion on names
        if count == len(at):
            break
        at = marked.pop()
        fresh = np.zeros_like(names)
        count = _name(at, [names[at], names[at + first], names[at + second]], fresh)
        names = fresh
    byte = lambda p: w[p] >> np.uint64(56)
    sampled = starts[starts % 3 != 0]
    sampled = sampled[np.argsort(names[sampled], kind="stable")]
    rest = starts[starts % 3 == 0]
    rest = rest[np.lexsort((names[rest + 1], byte(rest)))]
    if not len(rest) or not len(sampled):
        return np.concatenate([sampled, rest])
    # merge: how many sampled suffixes are less than each of the rest
    low, high = np.zeros(len(rest), np.int64), np.full(len(rest), len(sampled), np.int64)
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            break
        mid = (low[open_] + high[open_]) >> 1
        i, j = rest[open_], sampled[mid]
        one = j % 3 == 1
        bi, bj = byte(i), byte(j)
        ci, cj = np.where(one, 0, byte(i + 1)), np.where(one, 0, byte(j + 1))
        ni, nj = np.where(one, names[i + 1], names[i + 2]), np.where(one, names[j + 1], names[j + 2])
        less = (bj < bi) | ((bj == bi) & ((cj < ci) | ((cj == ci) & (nj < ni))))
        low[open_[less]] = mid[less] + 1
        high[open_[~less]] = mid[~less]
    # the rest's own order must hold too; among suffixes equal to the depth either order is right
    place = np.maximum.accumulate(low) + np.arange(len(rest))
    out = np.empty(len(starts), np.int64)
    taken = np.zeros(len(starts), bool)
    taken[place] = True
    out[taken], out[~taken] = rest, sampled
    return out


def equal_groups(text: np.ndarray, order: np.ndarray, size: int) -> np.ndarray:
    """Whether each suffix in ``order`` begins a new group: its first ``size`` bytes differ from
    those of the one before (adjacent prefixes)."""
    w = letters(text, size + 16)
    new = np.ones(len(order), bool)
    if len(order) > 1:
        same = np.ones(len(order) - 1, bool)
        whole = size >= 8
        for shift in ([*range(0, size - 7, 8), size - 8] if whole else []):
            x = w[order + shift]
            same &= x[1:] == x[:-1]
        if not whole:
            x = w[order] >> np.uint64(64 - 8 * size)
            same &= x[1:] == x[:-1]
        new[1:] = ~same
    return new


# --- distribution -------------------------------------------------------------------------------


def anchored_runs(data: np.ndarray, offsets: np.ndarray, size: int = SIZE, k: int = ANCHOR, piece: int = 1 << 18):
    """Runs of consecutive string starts with one anchor: first start, count, anchor hash, row.
    Rows are taken ``piece`` bytes at a time, as the arrays on the way are many times as large."""
    parts, i, last = [], 0, len(offsets) - 1
    while i < last:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + piece, side="right")) - 1)
        begin, count, anchor, row = _anchored_runs(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], size, k)
        parts.append((begin + offsets[i], count, anchor, row + i))
        i = j
    return tuple(np.concatenate(x) for x in zip(*parts)) if parts else _anchored_runs(data, offsets, size, k)


def _anchored_runs(data: np.ndarray, offsets: np.ndarray, size: int, k: int):
    none = np.zeros(0, np.int64)
    width = size - k + 1
    lengths = np.diff(offsets)
    long_ = lengths >= size
    if len(data) < size or not long_.any():
        return none, none, np.zeros(0, np.uint64), none
    h = mix(rolling(data, k))
    m, have = h, 1
    while have * 2 <= width:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    if have < width:
        m = np.minimum(m[: len(m) - (width - have)], m[width - have :])
    starts = ranges(offsets[:-1][long_], lengths[long_] - size + 1)
    least = m[starts]
    new = np.r_[True, (least[1:] != least[:-1]) | (starts[1:] != starts[:-1] + 1)]
    first = np.flatnonzero(new)
    count = np.diff(np.r_[first, len(starts)])
    view = np.lib.stride_tricks.sliding_window_view(h, width)

    def leftmost(at, value):
        out = np.empty(len(at), np.int64)
        for a in range(0, len(at), 1 << 17):
            out[a : a + (1 << 17)] = at[a : a + (1 << 17)] + (view[at[a : a + (1 << 17)]] == value[a : a + (1 << 17), None]).argmax(axis=1)
        return out

    begin = starts[first]
    place = leftmost(begin, least[first])
    tied = begin + count - 1 > place  # the least hash stands at more than one place
    if tied.any():
        each = ranges(first[tied], count[tied])
        own = leftmost(starts[each], least[each])
        fresh = np.r_[True, (own[1:] != own[:-1]) | (starts[each][1:] != starts[each][:-1] + 1)]
        b2 = starts[each][fresh]
        c2 = np.diff(np.r_[np.flatnonzero(fresh), len(each)])
        begin, count, place = np.r_[begin[~tied], b2], np.r_[count[~tied], c2], np.r_[place[~tied], own[fresh]]
        order = np.argsort(begin, kind="stable")
        begin, count, place = begin[order], count[order], place[order]
    # mixed anew: least hashes are small ones, and buckets go by the leading bits
    return begin, count, mix(h[place] ^ np.uint64(0x5851F42D4C957F2D)), np.searchsorted(offsets, begin, side="right") - 1


def _order_ids(ids) -> np.ndarray:
    return np.array([_NULL if i is None else i for i in ids], np.int64)


def _send_anchors(chunks: DataFrame, bits: int, size: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):  # one by one: a chunk is large
                chunk, ids, text, bounds = (batch.column(batch.schema.get_field_index(c))[i].as_py() for c in ("chunk", "ids", "text", "bounds"))
                data, offsets = unpack(text, bounds)
                _, _, anchor, row = anchored_runs(data, offsets, size)
                order = np.argsort(anchor, kind="stable")
                a, d = anchor[order], _order_ids(ids)[row[order]]
                cuts = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.zeros(0, np.int64)
                many = np.minimum.reduceat(d, cuts) != np.maximum.reduceat(d, cuts) if len(cuts) else np.zeros(0, bool)
                u = a[cuts]
                short = ((u << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
                rows = [(b, chunk, short[x:y].tobytes(), np.packbits(many[x:y]).tobytes()) for b, x, y in by_bucket(u, bits)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["bucket", "chunk", "p", "q"])

    return chunks.mapInArrow(run, "bucket bigint, chunk bigint, p binary, q binary")


def _repeated(t: pa.Table) -> pa.Table:
    """In a bucket: which of each chunk's anchors another chunk or document has too."""
    parts = frombytes(t["p"], np.uint32)
    sizes = [len(p) for p in parts]
    whole = np.concatenate(parts)
    many = np.concatenate([np.unpackbits(q, count=n).astype(bool) for q, n in zip(frombytes(t["q"], np.uint8), sizes)])
    order = np.argsort(whole, kind="stable")
    s = whole[order]
    same = np.r_[False, s[1:] == s[:-1]]
    flag = np.zeros(len(s), bool)
    flag[order] = same | np.r_[same[1:], False]
    flag |= many
    out, at = [], 0
    for n in sizes:
        out.append(np.packbits(flag[at : at + n]).tobytes())
        at += n
    return pa.table({"chunk": t["chunk"], "bucket": t["bucket"], "n": pa.array(sizes, pa.int64()), "p": pa.array(out, pa.binary())})


_RUNS = "bucket bigint, chunk bigint, n bigint, contents binary, counts binary, anchors binary, docs binary, pos binary, cls binary, least binary"


def _send_runs(chunks: DataFrame, flags: DataFrame, bits: int, size: int) -> DataFrame:
    kinds = [pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * 7]
    names = [c.split()[0] for c in _RUNS.split(", ")]

    def run(t: pa.Table) -> pa.Table:
        ids, data, offsets, order = split_chunk(t)
        n, p = t["n"].to_pylist(), t["p"]
        flag = np.concatenate([np.zeros(0, bool), *(np.unpackbits(np.frombuffer(p[i].as_py(), np.uint8), count=n[i]).astype(bool) for i in order)])
        begin, count, anchor, row = anchored_runs(data, offsets, size)
        u, inverse = np.unique(anchor, return_inverse=True)
        kept = flag[inverse] if len(u) else np.zeros(0, bool)
        begin, count, anchor, docs = begin[kept], count[kept], anchor[kept], _order_ids(ids)[row[kept]]
        content = span_hashes(data, begin, begin + count + size - 1)
        by = np.lexsort((docs, content, anchor))
        a, c, d = anchor[by], content[by], docs[by]
        new = np.r_[True, (a[1:] != a[:-1]) | (c[1:] != c[:-1])] if len(a) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        cls = np.cumsum(new) - 1
        least = d == d[first][cls] if len(first) else np.zeros(0, bool)
        pack = zstandard.ZstdCompressor(level=3)
        rows = []
        ends = np.r_[first[1:], len(a)]
        for b, x, y in by_bucket(a[first], bits):
            f = by[first[x:y]]
            i, j = first[x], ends[y - 1]
            text = data[ranges(begin[f], count[f] + size - 1)]
            step = np.r_[False, cls[i + 1 : j] != cls[i : j - 1]]  # classes are numbered in order
            short = ((anchor[f] << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
            rows.append((b, int(t["chunk"][0].as_py()), y - x, pack.compress(text.tobytes()), count[f].astype(np.uint8).tobytes(), short.tobytes(), pack.compress(docs[f].tobytes()), begin[by[i:j]].astype(np.uint32).tobytes(), np.packbits(step).tobytes(), np.packbits(least[i:j]).tobytes()))
        release()
        return pa.table([pa.array([r[k] for r in rows], kinds[k]) for k in range(len(kinds))], names=names)

    return meet(chunks, flags, run, _RUNS)


def _judge(t: pa.Table, size: int) -> pa.Table:
    """In a bucket: which starts of each run repeat a string of a smaller document."""
    counts = np.concatenate(frombytes(t["counts"], np.uint8)).astype(np.int64)
    anchor = np.concatenate(frombytes(t["anchors"], np.uint32))
    unzip = zstandard.ZstdDecompressor()
    doc = np.concatenate([np.frombuffer(unzip.decompress(x), np.int64) for x in t["docs"].to_pylist()])
    text = np.frombuffer(b"".join(unzip.decompress(x) for x in t["contents"].to_pylist()), np.uint8)
    lengths = counts + size - 1
    starts = np.r_[0, np.cumsum(lengths)[:-1]]
    content = np.empty(len(counts), np.uint64)
    a = 0
    while a < len(counts):  # hashed in pieces, for bounded memory
        b = max(a + 1, int(np.searchsorted(starts, starts[a] + (1 << 20))))
        base = starts[a]
        content[a:b] = span_hashes(text[base : starts[b - 1] + lengths[b - 1]], starts[a:b] - base, starts[a:b] + lengths[a:b] - base)
        a = b
    by = np.lexsort((doc, content, anchor))
    new = np.r_[True, (anchor[by][1:] != anchor[by][:-1]) | (content[by][1:] != content[by][:-1])]
    first = by[np.flatnonzero(new)]  # one run for each text, of the smallest document
    group = np.empty(len(by), np.int64)
    group[by] = np.cumsum(new) - 1
    least = doc[first]
    # texts that share their anchor with no other text are decided: only their smallest document keeps them
    sizes = np.bincount(np.cumsum(np.r_[True, anchor[first][1:] != anchor[first][:-1]]) - 1)
    shared = np.flatnonzero(np.repeat(sizes, sizes) > 1)
    mask = np.zeros(len(first), np.uint32)
    if len(shared):
        f = first[shared]
        part = text[ranges(starts[f], lengths[f])]
        at = np.r_[0, np.cumsum(lengths[f])[:-1]]
        suffixes = ranges(at, counts[f])
        owner = np.repeat(np.arange(len(shared)), counts[f])
        where = np.full(len(part), -1, np.int64)
        where[suffixes] = owner
        order = sort_suffixes(part, suffixes, size)
        head = np.flatnonzero(equal_groups(part, order, size))
        docs = least[shared][where[order]]
        smallest = np.repeat(np.minimum.reduceat(docs, head), np.diff(np.r_[head, len(order)]))
        hit = order[smallest < docs]
        np.bitwise_or.at(mask, shared[where[hit]], np.uint32(1) << (hit - at[where[hit]]).astype(np.uint32))
    full = ((np.uint64(1) << counts.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)
    sent = np.where(doc > least[group], full, mask[group])
    out_p, out_q, out_n, at = [], [], [], 0
    for n, pos, cls, low in zip(t["n"].to_pylist(), frombytes(t["pos"], np.uint32), frombytes(t["cls"], np.uint8), frombytes(t["least"], np.uint8)):
        cls = np.cumsum(np.unpackbits(cls, count=len(pos)))
        mine = np.where(np.unpackbits(low, count=len(pos)).astype(bool), sent[at + cls], full[at + cls])
        at += n
        some = mine != 0
        out_p.append(pos[some].tobytes())
        out_q.append(mine[some].tobytes())
        out_n.append(int(some.sum()))
    release()
    return pa.table({"chunk": t["chunk"], "bucket": t["bucket"], "n": pa.array(out_n, pa.int64()), "p": pa.array(out_p, pa.binary()), "q": pa.array(out_q, pa.binary())})


_FOUND = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, kept_sha256 string"


def _cut_out(size: int, text: bool):
    def run(t: pa.Table) -> pa.Table:
        ids, data, offsets, order = split_chunk(t)
        gone = np.zeros(len(data) + 1, np.int32)
        for i in order:
            pos, mask = np.frombuffer(t["p"][i].as_py(), np.uint32).astype(np.int64), np.frombuffer(t["q"][i].as_py(), np.uint32)
            for bit in range(size - ANCHOR + 1):
                s = pos[(mask >> np.uint32(bit)) & np.uint32(1) == 1] + bit
                gone[s] += 1  # a start belongs to one run only
                gone[s + size] -= 1
        covered = np.cumsum(gone[:-1]) > 0
        total = np.r_[0, np.cumsum(covered)]
        new = covered & ~np.r_[False, covered[:-1]]
        new[offsets[:-1][offsets[:-1] < len(data)]] |= covered[offsets[:-1][offsets[:-1] < len(data)]]
        spans = np.r_[0, np.cumsum(new)]
        release()
        kept = [data[a:b][~covered[a:b]].tobytes() if total[b] > total[a] else data[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "n_bytes": np.diff(offsets),
                "n_removed": np.diff(total[offsets]),
                "n_spans": np.diff(spans[offsets]),
                "kept": pa.array(kept if text else [None] * len(kept), pa.binary()),
                "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
            }
        )

    return run


def remove_repeats(docs: DataFrame, size: int = SIZE, text: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary; null unless ``text``), kept_sha256: a row for
    each row of ``docs`` (doc_id, text). ``size``: bytes of a repeated string, 25 to 55."""
    if not ANCHOR < size <= ANCHOR + 31:
        raise ValueError("size must be from 25 to 55")
    chunks = chunked(docs)
    bits = bucket_bits(chunks)
    flags = _send_anchors(chunks, bits, size).groupBy("bucket").applyInArrow(_repeated, "chunk bigint, bucket bigint, n bigint, p binary")
    runs = _send_runs(chunks, flags, bits, size)
    judged = runs.groupBy("bucket").applyInArrow(lambda t: _judge(t, size), "chunk bigint, bucket bigint, n bigint, p binary, q binary")
    return meet(chunks, judged, _cut_out(size, text), _FOUND)


def op2_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), text=False).drop("kept")
