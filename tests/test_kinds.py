import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_cells import joined, records

from linkwright.functions import text as T
from linkwright.operators import blocking, cells


@pytest.mark.parametrize("gain, seeds, pairs", [(0, 32, 1 << 20), (0, 1, 60), (0, 3, 500)])
def test_kinds_find_what_joins_find(spark, monkeypatch, gain, seeds, pairs):
    """Equal rows if all records are compared by kinds, for every number of seeds and size of runs."""
    s1, target = records(spark, 1, 120, 0), records(spark, 2, 150, 100)
    inside = cells.best

    def by_kinds(*args):
        cells.KIND_GAIN, cells.SEEDS, cells.PAIRS = gain, seeds, pairs
        return inside(*args)

    monkeypatch.setattr(cells, "best", by_kinds)
    for k in (1, 3, 1000):
        got, want = (sorted(tuple(map(str, r)) for r in df.collect()) for df in (blocking.generate(s1, target, "source2", k=k, max_posting=20), joined(s1, target, k)))
        assert got == want and len(want) >= 100


def table(rng, prefix, n, rare):
    """Many records of few names and addresses, some ids on both sides; signatures follow name and postal code."""
    rows = {c: [] for c in ("id", "name_tokens", "address_tokens", "postal_code_normalized", "postal_prefix", "street_number", "country_normalized", "signature", "rare" if rare else "tokens")}
    for i in range(n):
        a, b, p = rng.randrange(12), rng.randrange(10), rng.choice(["", "10", "20", "30"])
        name, address = [f"n{a % 4}", f"m{a}"], [f"a{b}", f"b{b % 3}"]
        tokens = name + address
        held = [{"key": t, "weight": 1.0 + len(t) * int(t[1:]) / 7} for t in tokens if int(t[1:]) > 6]
        values = (f"x{i}" if i % 50 == 0 else f"{prefix}{i}", name, address, p, p[:1], str(b) if b > 2 else "", "peru", [hash((a * 31 + b * 7 + len(p) * int(p or 0) + s // 2) % 97) for s in range(8)], held if rare else tokens)
        for c, v in zip(rows, values):
            rows[c].append(v)
    types = {"rare": pa.list_(pa.struct([("key", pa.string()), ("weight", pa.float64())])), "signature": pa.list_(pa.int64())}
    return pa.table({c: pa.array(v, types.get(c)) for c, v in rows.items()})


def test_few_pairs_are_scored_where_records_repeat(monkeypatch):
    """The same best as by all pairs, though far fewer are scored: seven in eight are told by their kinds."""
    rng = random.Random(5)
    left, right = table(rng, "l", 900, False), table(rng, "r", 1200, True)
    seen = []
    units = cells._Cell.units
    monkeypatch.setattr(cells._Cell, "units", lambda self, i, *x: seen.append(len(i)) or units(self, i, *x))
    rows = lambda found: sorted(zip(*(np.concatenate(x).tolist() for x in zip(*found))))
    got = rows(cells.best(left, right, 8, 4))
    scored, seen[:] = sum(seen), []
    want = rows(cells._Cell(left, right, 8, 4).joined())
    assert got == want and len(want) > 7000
    assert 8 * scored < sum(seen)


def test_signatures_are_those_of_the_expression(spark):
    """Signatures made over arrays are those of the expression over each record's n-grams, which a plan no longer holds."""
    texts = ["", " ", "a", "ab  C", "Größe été 日本語 😀", "x" * 300, "large ring brand 7", "\t", "nation 1 \t 10001"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, brand_name string").withColumns({c: F.lit("") for c in ("normalized_address", "city_normalized", "region_normalized", "country_normalized", "postal_code_normalized")})
    got = blocking.with_signature(rows)
    h, signature = blocking.minhash(T.shingles("_text", 3))
    want = rows.withColumn("_text", blocking.record_text()).withColumn("_h", h).withColumn("signature", signature)
    rows = lambda df: [r[0] for r in df.orderBy("id").select("signature").collect()]
    assert rows(got) == rows(want) and rows(got)[0] == [blocking.PRIME] * 48
    assert "zip_with" not in got._jdf.queryExecution().optimizedPlan().toString()
