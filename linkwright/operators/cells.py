"""Scored candidates without a row for each pair: records are dealt to cells, and only winners leave one.

A cell holds a part of one country's source-1 records and a part of the targets of that country, or of those
without one (records without a country meet all targets), so every pair that the country rule allows
meets in exactly one cell. There the blockers' keys are joined as arrays, in runs of records whose
pairs fit in ``PAIRS``; pairs are united, scored and cut to each record's best ``k``. Where records of equal
name and address abound, a pair of a common key is scored unless its kinds (``_Kinds``) show that it cannot be among the
best ``k``; elsewhere all are. The result is the same. Ties go to the smaller target id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Possible pairs of one run of records in a cell.
PAIRS = 1 << 20
#: Records of one side in a cell.
LEFT, RIGHT = 1 << 16, 1 << 16
#: Cells are made smaller where this many do not come about (source-1 records, at least ``FEWEST`` in each).
CELLS, FEWEST = 32, 512
#: Records of a task that are packed at once.
PACKED = 1 << 16
#: Pairs of different token sets whose shared tokens are counted once for a whole cell.
GRID = 1 << 24
#: Records are compared by kinds where these make this many times fewer pairs than the keys.
KIND_GAIN = 2
#: Kinds of highest bounds that a record may begin with.
SEEDS = 32
#: What rounding may add to a score.
SLACK = 1e-8
MINHASH, TOKEN = 1, 2
#: What tells a cell: countries and parts of both sides.
CELL = ("ca", "cb", "pna", "pnb")
#: Ids of targets in one list, about, and in one batch.
RUN, SENT = 1 << 12, 1 << 19


def _codes(left: pa.Array, right: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of values: equal values, equal numbers; a blank or null one has -1."""
    both = pa.concat_arrays([left, right])
    at = both.dictionary_encode()
    codes = at.indices.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    codes[pc.fill_null(pc.equal(both, ""), True).to_numpy(zero_copy_only=False)] = -1
    return codes[: len(left)], codes[len(left) :]


def _lists(table: pa.Table, name: str) -> tuple[pa.Array, np.ndarray]:
    """The values of a list column in one array, and the row of each."""
    column = table[name].combine_chunks()
    n = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return column.flatten(), np.repeat(np.arange(len(n)), n)


def _tokens(left: pa.Table, right: pa.Table, name: str) -> "_Sets":
    (a, ra), (b, rb) = _lists(left, name), _lists(right, name)
    at = pa.concat_arrays([a, b]).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return _Sets(_classes(at[: len(a)], ra, left.num_rows, -1), _classes(at[len(a) :], rb, right.num_rows, -2))


def _classes(codes: np.ndarray, rows: np.ndarray, n: int, blank: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different token sets (one row of numbers each, filled up with ``blank``), their sizes, and the set of each row."""
    span = int(codes.max(initial=0)) + 1
    packed = np.unique(rows * span + codes)
    rows, codes = packed // span, packed % span
    size = np.bincount(rows, minlength=n)
    sets = np.full((n, max(1, int(size.max(initial=0)))), blank, np.int32)
    sets[rows, np.arange(len(rows)) - np.repeat(np.cumsum(size) - size, size)] = codes
    sets, which = np.unique(sets, axis=0, return_inverse=True)
    return sets, (sets != blank).sum(axis=1), which.ravel()


class _Sets:
    """Token sets of both sides; ``jaccard`` of pairs of rows."""

    def __init__(self, left, right):
        (self.a, self.na, self.of_a), (self.b, self.nb, self.of_b) = left, right
        self.grid = self.shares = None

    def prepare(self, pairs: int) -> None:
        """Counts what each two sets share, if these are fewer than the pairs to come."""
        if len(self.a) * len(self.b) <= min(pairs, GRID):
            grid = np.zeros((len(self.a), len(self.b)), np.uint16)
            for x in self.a.T:
                for y in self.b.T:
                    grid += x[:, None] == y[None, :]
            self.grid = grid

    def jaccard(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        i, j = self.of_a[i], self.of_b[j]
        if self.grid is not None:
            both = self.grid[i, j].astype(np.int64)
        else:
            both = np.zeros(np.broadcast_shapes(i.shape, j.shape), np.int64)
            right = [y[j] for y in self.b.T]
            for x in self.a.T:
                x = x[i]
                for y in right:
                    both += x == y
        either = self.na[i] + self.nb[j] - both
        return both / np.maximum(either, 1)

    def outer(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """``jaccard`` of each of ``i`` with each of ``j``."""
        if self.grid is None:
            return self.jaccard(i[:, None], j[None, :])
        if self.shares is None:
            self.shares = self.grid / np.maximum(self.na[:, None] + self.nb[None, :] - self.grid.astype(np.int64), 1)
        return np.take(np.take(self.shares, self.of_a[i], 0), self.of_b[j], 1)


class _Key:
    """One key of a blocker: for rows of the left side, the right rows of equal key (-1 is none)."""

    def __init__(self, left: np.ndarray, right: np.ndarray, left_rows: np.ndarray | None = None, right_rows: np.ndarray | None = None):
        # entries are in the order of their rows on the left, of their keys on the right
        self.rows = np.arange(len(left)) if left_rows is None else left_rows
        self.order = np.argsort(right, kind="stable")
        held = right[self.order]
        self.begin = np.searchsorted(held, left, "left")
        self.n = np.where(left >= 0, np.searchsorted(held, left, "right") - self.begin, 0)
        self.row_of = None if right_rows is None else right_rows
        self.pairs = int(self.n.sum())

    def of(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Left rows (from ``first``, before ``last``), right rows and right entries."""
        a, b = np.searchsorted(self.rows, (first, last))
        n = self.n[a:b]
        total = int(n.sum())
        entry = self.order[np.arange(total) - np.repeat(np.cumsum(n) - n - self.begin[a:b], n)]
        return np.repeat(self.rows[a:b], n), entry if self.row_of is None else self.row_of[entry], entry


def _bands(left: pa.Table, right: pa.Table, bands: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Numbers of the values of each band."""
    sides = [t["signature"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int32).reshape(t.num_rows, -1) for t in (left, right)]
    width = sides[0].shape[1] // bands
    out = []
    for k in range(bands):
        codes = _joint(*np.concatenate([s[:, k * width : (k + 1) * width] for s in sides]).T.astype(np.int64))[0]
        out.append((codes[: left.num_rows], codes[left.num_rows :]))
    return out


def _met(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many of ``right`` are equal to each of ``left`` (-1 is none)."""
    held = np.bincount(right + 1, minlength=int(left.max(initial=-1)) + 2)
    held[0] = 0
    return held[left + 1]


def _joint(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of rows of several codes: equal rows, equal numbers; and the first row of each number."""
    out = np.zeros(len(columns[0]), np.int64)
    for c in columns:
        least = int(c.min(initial=0))
        out = np.unique(out * (int(c.max(initial=0)) - least + 1) + c - least, return_inverse=True)[1]
    return out, np.unique(out, return_index=True)[1]


def _sequences(codes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Numbers of lists of codes: equal lists, equal numbers."""
    size = np.bincount(rows, minlength=n)
    place = np.arange(len(rows)) - np.repeat(np.cumsum(size) - size, size)
    out = np.zeros(n, np.int64)
    for k in range(int(size.max(initial=0))):
        here = np.full(n, -1, np.int64)
        here[rows[place == k]] = codes[place == k]
        out = _joint(out, here)[0]
    return out


def _spans(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of each, ``n`` of them."""
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n - begin, n)


class _Cell:
    """What the records of a cell are compared by."""

    def __init__(self, left: pa.Table, right: pa.Table, k: int, bands: int):
        self.n, self.m, self.k = left.num_rows, right.num_rows, k
        ids = right["id"].combine_chunks()
        self.by_id = pc.sort_indices(ids).to_numpy().astype(np.int64)
        self.place = np.empty(self.m, np.int64)
        self.place[self.by_id] = np.arange(self.m)
        # a class of records has no id of its own
        self.ids = _codes(left["own" if "own" in left.column_names else "id"].combine_chunks(), ids)
        self.names, self.addresses = _tokens(left, right, "name_tokens"), _tokens(left, right, "address_tokens")
        field = lambda c: _codes(left[c].combine_chunks(), right[c].combine_chunks())
        self.postal, self.prefix, self.street = field("postal_code_normalized"), field("postal_prefix"), field("street_number")
        (said, self.said_rows), (rare, self.rare_rows) = _lists(left, "tokens"), _lists(right, "rare")
        self.said, self.rare = _codes(said, rare.field("key"))
        self.weights = rare.field("weight").to_numpy(zero_copy_only=False)
        self.bands = _bands(left, right, bands)
        # pairs of each record by all keys
        self.met = sum(_met(*x) for x in (*self.bands, self.prefix, self.street))
        self.met = self.met + np.bincount(self.said_rows, _met(self.said, self.rare), minlength=self.n).astype(np.int64)
        self.names.prepare(int(self.met.sum())), self.addresses.prepare(int(self.met.sum()))
        self.bits = max(1, self.m.bit_length())
        self.most_rows = 1 << (32 - self.bits)

    def eq(self, field, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return (field[0][i] == field[1][j]) & (field[0][i] >= 0)

    def units(self, i: np.ndarray, j: np.ndarray, held: np.ndarray, shared) -> np.ndarray:
        """Scores in units of 1e-9; ``shared``: the weight of the tokens that both have."""
        weight = 1.5 * self.eq(self.prefix, i, j) + 0.5 * self.eq(self.street, i, j) + shared
        coarse = 0.68 * self.names.jaccard(i, j) + 0.20 * self.addresses.jaccard(i, j) + 0.08 * self.eq(self.postal, i, j) + 0.04 * self.eq(self.street, i, j)
        bonus = np.where(held == MINHASH | TOKEN, 0.1, 0.0)
        score = np.minimum(1.0, np.minimum(1.0, coarse) * 0.65 + np.minimum(weight / 10, 0.3) + bonus)
        return np.floor(score * 1e9 + 0.5).astype(np.int64)

    def top(self, row: np.ndarray, units: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best ``k`` of each row: row, target, units. Record, then score downwards, then target id, in one number."""
        bits = self.bits
        packed = np.sort((row << (30 + bits)) | ((10**9 - units) << bits) | self.place[j])
        row = packed >> (30 + bits)
        top = packed[np.arange(len(row)) - np.searchsorted(row, row) < self.k]
        return top >> (30 + bits), self.by_id[top & ((1 << bits) - 1)], 10**9 - ((top >> bits) & ((1 << 30) - 1))

    def joined(self) -> Iterator[tuple]:
        """The best of all records, by all pairs of the keys."""
        n, m = self.n, self.m
        same, token = _Key(*self.ids), _Key(self.said, self.rare, self.said_rows, self.rare_rows)
        minhash, others = [_Key(*x) for x in self.bands], [_Key(*self.prefix), _Key(*self.street)]
        step = max(1, min(PAIRS // max(m, 1), self.most_rows))
        for first in range(0, n, step):
            last = min(n, first + step)
            flags = np.zeros((last - first) * m, np.uint8)
            for key in minhash:
                i, j, _ = key.of(first, last)
                flags[(i - first) * m + j] = MINHASH
            for key in others:
                i, j, _ = key.of(first, last)
                flags[(i - first) * m + j] |= TOKEN
            i, j, entry = token.of(first, last)
            shared = (i - first) * m + j
            flags[shared] |= TOKEN
            i, j, _ = same.of(first, last)
            flags[(i - first) * m + j] = 0
            found = np.flatnonzero(flags)
            if not len(found):
                continue
            held = flags[found]
            row, j = np.divmod(found, m)
            weight = 0.0
            if len(shared):
                at = np.minimum(np.searchsorted(found, shared), len(found) - 1)
                kept = found[at] == shared
                weight = np.bincount(at[kept], self.weights[entry[kept]], minlength=len(found))
            row, j, units = self.top(row, self.units(row + first, j, held, weight), j)
            yield row + first, j, flags[row * m + j], units / 1e9

    def kinds(self) -> "_Kinds | None":
        """Records by kinds, if these make far fewer pairs than the keys do."""
        right = self.rare * (int(len(self.weights)) + 1) + np.unique(self.weights, return_inverse=True)[1]
        order = np.lexsort((right, self.rare_rows))
        of_left = _joint(self.names.of_a, self.addresses.of_a, self.street[0], _sequences(self.said, self.said_rows, self.n))
        of_right = _joint(self.names.of_b, self.addresses.of_b, self.street[1], _sequences(right[order], self.rare_rows[order], self.m))
        return _Kinds(self, of_left, of_right) if len(of_left[1]) * len(of_right[1]) * KIND_GAIN <= self.met.sum() else None


class _Kinds:
    """Records of one name, address, street number and tokens are of one kind. Two kinds bound the scores of all
    pairs of theirs: only postal codes, areas and MinHash bands are not known. A record is compared with the targets of
    the kinds of highest bounds first, then with all whose bound its ``k``-th best score does not pass: the others
    cannot be among its best. Records that agree in all but their ids are compared once, and of such targets
    the ``k`` + 1 of smallest ids are enough (one may be the record itself)."""

    def __init__(self, cell: _Cell, left, right):
        self.cell, (self.of_left, self.first_left), (of_right, self.first_right) = cell, left, right
        bands = [_joint(*(x[side] for x in cell.bands))[0] for side in (0, 1)]
        own = np.where(_met(*cell.ids) > 0, cell.ids[0], -1)
        self.twin, self.first_twin = _joint(self.of_left, cell.postal[0], cell.prefix[0], bands[0], own)
        alike = _joint(of_right, cell.postal[1], cell.prefix[1], bands[1])[0]
        order = np.lexsort((cell.place, alike))
        rank = np.arange(cell.m) - np.searchsorted(alike[order], alike[order])
        kept = order[rank <= cell.k]
        self.targets = kept[np.argsort(of_right[kept], kind="stable")]
        self.n = np.bincount(of_right[kept], minlength=len(self.first_right))
        self.begin = np.cumsum(self.n) - self.n
        self.twins = np.bincount(self.of_left[self.first_twin], minlength=len(self.first_left))

    def shared(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Kinds of both sides that share a rare token, and the weight of each: entries by kinds of the left side."""
        c = self.cell
        kind_l, kind_r = np.full(c.n, -1), np.full(c.m, -1)
        kind_l[self.first_left], kind_r[self.first_right] = np.arange(len(self.first_left)), np.arange(len(self.first_right))
        a, b = kind_l[c.said_rows] >= 0, kind_r[c.rare_rows] >= 0
        order = np.flatnonzero(a)[np.argsort(kind_l[c.said_rows[a]], kind="stable")]
        key = _Key(c.said[order], c.rare[b], kind_l[c.said_rows[order]], kind_r[c.rare_rows[b]])
        return key, c.weights[b]

    def pairs(self, twin: np.ndarray, kind: np.ndarray, shared: np.ndarray, token: np.ndarray):
        """Candidates among the pairs of ``twin`` and the targets of ``kind``: twin, target, methods and units."""
        c, out = self.cell, []
        ends = np.cumsum(self.n[kind])
        cuts = np.unique(np.searchsorted(ends, np.arange(PAIRS, int(ends[-1]) if len(ends) else 0, PAIRS)))
        for part in np.split(np.arange(len(kind)), cuts):
            n = self.n[kind[part]]
            at, j = np.repeat(part, n), self.targets[_spans(self.begin[kind[part]], n)]
            t = twin[at]
            i = self.first_twin[t]
            held = np.where(token[at] | c.eq(c.prefix, i, j), TOKEN, 0).astype(np.uint8)
            hit = np.zeros(len(i), bool)
            for a, b in c.bands:
                hit |= a[i] == b[j]
            held[hit] |= MINHASH
            good = (held > 0) & ~c.eq(c.ids, i, j)
            t, i, j, held, at = t[good], i[good], j[good], held[good], at[good]
            out.append((t, j, held, c.units(i, j, held, shared[at])))
        return tuple(np.concatenate(x) for x in zip(*out))

    def best(self) -> Iterator[tuple]:
        """As ``_Cell.joined``, but for the records of ``self.rest``, which it leaves."""
        c, k = self.cell, self.cell.k
        kinds, wide = len(self.first_left), len(self.first_right)
        key, weights = self.shared()
        starts = np.cumsum(self.twins) - self.twins
        by_kind = np.argsort(self.of_left[self.first_twin], kind="stable")  # twins in the order of their kinds
        order = np.argsort(self.twin, kind="stable")  # records in the order of their twins
        held_by = np.bincount(self.twin, minlength=len(self.first_twin))
        record_at = np.cumsum(held_by) - held_by
        self.rest = [np.zeros(0, np.int64)]
        step = max(1, PAIRS // max(wide, 1))
        for first in range(0, kinds, step):
            last = min(kinds, first + step)
            i, j = self.first_left[first:last], self.first_right
            street = c.eq(c.street, i[:, None], j[None, :])
            shared, token = np.zeros(street.shape), street.copy()
            if key.pairs:
                a, b, entry = key.of(first, last)
                flat = (a - first) * wide + b
                shared += np.bincount(flat, weights[entry], minlength=shared.size).reshape(shared.shape)
                token.ravel()[flat] = True
            coarse = 0.68 * c.names.outer(i, j) + 0.20 * c.addresses.outer(i, j) + (0.08 + 0.04 * street)
            bound = np.minimum(1.0, coarse) * 0.65 + np.minimum((shared + 0.5 * street + 1.5) / 10, 0.3) + (0.1 + SLACK)
            np.minimum(bound, 1.0, out=bound)
            near = np.argpartition(bound, -min(SEEDS, wide), axis=1)[:, -min(SEEDS, wide) :]
            near = np.take_along_axis(near, np.argsort(-np.take_along_axis(bound, near, 1), axis=1), 1)
            n = self.n[near]
            seed = np.cumsum(n, axis=1) - n < 4 * k
            a, b = np.nonzero(seed)
            seeds = np.zeros(street.shape, bool)
            seeds[a, near[a, b]] = True
            own = by_kind[starts[first] : starts[last - 1] + self.twins[last - 1]]
            load = (n * seed).sum(axis=1)[self.of_left[self.first_twin[own]] - first]
            for part in np.split(own, np.unique(np.searchsorted(np.cumsum(load), np.arange(PAIRS, load.sum(), PAIRS)))):
                for at in range(0, len(part), c.most_rows):
                    yield from self._chunk(part[at : at + c.most_rows], first, bound, seeds, shared, token, order, record_at, held_by)

    def _chunk(self, twins, first, bound, seeds, shared, token, order, record_at, held_by):
        c, k = self.cell, self.cell.k
        if not len(twins):
            return
        kind = self.of_left[self.first_twin[twins]] - first
        low, high = kind[0], kind[-1] + 1
        number = np.full(len(self.first_twin), -1)
        number[twins] = np.arange(len(twins))
        size = np.bincount(kind - low, minlength=high - low)
        begin = np.cumsum(size) - size

        def spread(a, b):
            """Kinds of both sides, as twins of the left one and kinds of the right one."""
            at, n = _spans(begin[a], size[a]), size[a]
            return at, np.repeat(b, n)

        at, b = spread(*np.nonzero(seeds[low:high]))
        g = kind[at]
        t, j, held, units = self.pairs(twins[at], b, shared[g, b], token[g, b])
        row = number[t]
        top = c.top(row, units, j)
        # the k-th best so far, of records that have as many
        count = np.bincount(top[0], minlength=len(twins))
        known = count >= k
        least = np.full(len(twins), np.inf)
        np.minimum.at(least, top[0], top[2] / 1e9)
        least[~known] = np.inf
        floor = np.full(high - low, np.inf)
        np.minimum.at(floor, kind - low, least)
        at, b = spread(*np.nonzero((bound[low:high] >= floor[:, None]) & ~seeds[low:high]))
        g = kind[at]
        open_ = bound[g, b] >= least[at]
        at, b, g = at[open_], b[open_], g[open_]
        known &= np.bincount(at, self.n[b], minlength=len(twins)) <= c.met[self.first_twin[twins]]
        dear = ~known[at]
        at, b, g = at[~dear], b[~dear], g[~dear]
        mine = known[row]
        out = [(row[mine], j[mine], held[mine], units[mine])]
        if len(at):
            t, j, held, units = self.pairs(twins[at], b, shared[g, b], token[g, b])
            row = number[t]
            good = units >= np.floor(least[row] * 1e9 + 0.5)
            out.append((row[good], j[good], held[good], units[good]))
        row, j, held, units = (np.concatenate(x) for x in zip(*out))
        left = twins[~known]
        self.rest.append(order[_spans(record_at[left], held_by[left])])
        pair = np.argsort(row * c.m + j)
        top = c.top(row, units, j)
        methods = held[pair[np.searchsorted((row * c.m + j)[pair], top[0] * c.m + top[1])]]
        n = held_by[twins[top[0]]]
        records = order[_spans(record_at[twins[top[0]]], n)]
        yield records, np.repeat(top[1], n), np.repeat(methods, n), np.repeat(top[2], n) / 1e9


def best(left: pa.Table, right: pa.Table, k: int, bands: int):
    """source row, target row, methods (bits) and score of the best ``k`` targets of each row of ``left``."""
    cell = _Cell(left, right, k, bands)
    kinds = cell.kinds()
    if kinds is None:
        yield from cell.joined()
        return
    yield from kinds.best()
    rest = np.concatenate(kinds.rest)
    if len(rest):
        for row, *found in _Cell(left.take(rest), right, k, bands).joined():
            yield rest[row], *found


def _deal(sizes: dict, other: dict, fewest: int, most: int) -> tuple[dict, dict]:
    """Parts of each country on both sides. ``CELLS`` is a wish, so its limit may be passed by half; ``most`` is not."""
    wanted = max(fewest, sum(sizes.values()) // CELLS)
    return {c: max(-(-n // most), round(n / wanted)) for c, n in sizes.items()}, {c: -(-n // RIGHT) for c, n in other.items()}


def _pack(df: DataFrame, parts: dict) -> DataFrame:
    """country, part, records: ``df`` in rows of many records (of one part of a country each) as Arrow tables, since a record
    may be sent to many cells. Records do not leave their task for it."""

    def packed(rows: pa.Table) -> pa.RecordBatch:
        number = {c: k for k, c in enumerate(parts)}
        at = np.array([number[c] for c in rows["country_normalized"].to_pylist()], np.int64)
        at = at * (max(parts.values()) + 1) + rows["_h"].to_numpy() % np.array(list(parts.values()))[at]
        signature = rows["signature"].combine_chunks()
        signature = pa.ListArray.from_arrays(signature.offsets, signature.values.cast(pa.int32()))
        rows = rows.drop_columns("_h").set_column(rows.schema.get_field_index("signature"), "signature", signature)
        order = np.argsort(at, kind="stable")
        rows, at = rows.take(order).combine_chunks(), at[order]
        out = []
        for begin, n in zip(*np.unique(at, return_index=True, return_counts=True)[1:]):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
                writer.write_table(rows.slice(begin, n))
            country, part = divmod(int(at[begin]), max(parts.values()) + 1)
            out.append((list(parts)[country], part, sink.getvalue().to_pybytes()))
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.string(), pa.int32(), pa.binary()))], ["country", "part", "records"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= PACKED:
                yield packed(pa.Table.from_batches(held))
                held, n = [], 0
        if n:
            yield packed(pa.Table.from_batches(held))

    return df.withColumn("_h", F.pmod(F.xxhash64("id"), F.lit(1 << 30))).mapInArrow(run, "country string, part int, records binary")


def _unpack(packed: pa.Table) -> pa.Table:
    return _tables(packed["records"].combine_chunks())


def _tables(records: pa.Array) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(x.as_buffer()).read_all() for x in records]).combine_chunks()


def generate(s1: DataFrame, target: DataFrame, k: int, bands: int) -> DataFrame:
    """source1_id, target_id, methods, blocking_score, source1_country: the best ``k`` of each record in each of its cells.

    ``s1``: id, country, name_tokens, address_tokens, postal_code_normalized, postal_prefix, street_number, signature and
    tokens; ``target`` has ``rare`` (array of key and weight) for tokens."""
    a, b = _dealt(s1, target)
    kinds = [s1.schema["id"].dataType.simpleString(), target.schema["id"].dataType.simpleString()]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return nothing
        left, right = _unpack(left), _unpack(right)
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8), np.zeros(0)), *best(left, right, k, bands)]
        i, j, methods, score = (np.concatenate(x) for x in zip(*out))
        return pa.table({"source1_id": left["id"].take(i), "target_id": right["id"].take(j), "methods": methods.astype(np.int32), "blocking_score": score, "source1_country": left["country_normalized"].take(i)})

    schema = f"source1_id {kinds[0]}, target_id {kinds[1]}, methods int, blocking_score double, source1_country string"
    nothing = to_arrow_schema(StructType.fromDDL(schema)).empty_table()
    return a.groupBy(*CELL).cogroup(b.groupBy(*CELL)).applyInArrow(run, schema)


def meet(s1: DataFrame, target: DataFrame, bands: int) -> DataFrame:
    """source1_ids, target_ids: lists of ids, all of the one with all of the other, for rows (id, country, signature and ``ids``) that
    have an equal band. Each two rows meet once; lists of targets have about ``RUN`` ids at most."""
    a, b = _dealt(s1, target)
    whole = lambda x, name: x.groupBy(*CELL).agg(F.collect_list("records").alias(name))
    both = whole(a, "left").join(whole(b, "right"), list(CELL)).select("left", "right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                yield from listed(*(_tables(batch[c][at].values) for c in ("left", "right")))

    def listed(left: pa.Table, right: pa.Table) -> Iterator[pa.RecordBatch]:
        keys, m = [_Key(*x) for x in _bands(left, right, bands)], right.num_rows
        mine, ids = left["ids"].combine_chunks(), right["ids"].combine_chunks()
        size = ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        begin, ids = np.cumsum(size) - size, ids.flatten()
        step = max(1, min(PAIRS // m, 8 * SENT // max(1, int(size.sum()))))
        for first in range(0, left.num_rows, step):
            last = min(left.num_rows, first + step)
            flags = np.zeros((last - first) * m, bool)
            for key in keys:
                i, j, _ = key.of(first, last)
                flags[(i - first) * m + j] = True
            row, j = np.divmod(np.flatnonzero(flags), m)
            if not len(row):
                continue
            n = size[j]
            before = np.cumsum(n) - n
            head = np.searchsorted(row, row)  # the first of each row
            part = np.concatenate([[True], np.diff(row * (int(n.sum()) + 1) + (before - before[head]) // RUN) != 0])
            cuts = np.flatnonzero(part)
            for some in np.split(np.arange(len(cuts)), np.unique(np.searchsorted(before[cuts], np.arange(SENT, int(n.sum()), SENT)))):
                if not len(some):
                    continue
                lo, hi = cuts[some[0]], cuts[some[-1] + 1] if some[-1] + 1 < len(cuts) else len(row)
                offsets = np.append(before[cuts[some]], before[hi - 1] + n[hi - 1]) - before[lo]
                held = ids.take(pa.array(_spans(begin[j[lo:hi]], n[lo:hi])))
                yield pa.RecordBatch.from_arrays([mine.take(pa.array(row[cuts[some]] + first)), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), held)], ["source1_ids", "target_ids"])

    kinds = [x.schema["ids"].dataType.simpleString() for x in (s1, target)]
    return both.mapInArrow(run, f"source1_ids {kinds[0]}, target_ids {kinds[1]}")


def _dealt(s1: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides packed, with the cell of each (``CELL``): all that meet are in one."""
    spark = s1.sparkSession
    count = lambda df: {r["country_normalized"]: r["n"] for r in df.groupBy("country_normalized").agg(F.count("*").alias("n")).collect()}  # noqa: E731  a number for each country
    left, right = _deal(count(s1), count(target), FEWEST, LEFT)
    meets = [("", b) for b in right if "" in left] + [(a, b) for a in left if a != "" for b in {a, ""} if b in right]
    # several tasks for each cell wanted, so that few hold two cells
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * CELLS)

    def deal(df: DataFrame, own: str, parts: dict, others: str):
        """Each record once in its part of its country for each part of what that meets."""
        cells = spark.createDataFrame([(a, b, left[a], right[b]) for a, b in meets], "ca string, cb string, na int, nb int")
        mine = {"na": "pna", "nb": "pnb"}
        dealt = _pack(df, parts).join(F.broadcast(cells), F.col("country") == F.col(own))
        spread = F.explode(F.sequence(F.lit(0), F.col(others) - 1)).alias(mine[others])
        own_part = F.col("part").alias(next(x for k, x in mine.items() if k != others))
        return dealt.select("ca", "cb", own_part, spread, "records").repartition(n, *CELL)

    return deal(s1, "ca", left, "nb"), deal(target, "cb", right, "na")
