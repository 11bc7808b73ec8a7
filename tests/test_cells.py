import random

import pytest
from pyspark.sql import functions as F

from linkwright.operators import blocking, cells, prepare


def records(spark, seed, n, start):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)]
    rows = []
    for i in range(start, start + n):
        name = " ".join(rng.choice(words) for _ in range(rng.randint(0, 3)))
        rows.append((f"r{i}", name, f"{rng.randint(1, 6)} {rng.choice(words)} Street", rng.choice(["", "10001", "10002", "20001"]), rng.choice(["", "", "france", "peru"])))
    return prepare.prepare(spark.createDataFrame(rows, "id string, business_name string, business_address string, postal_code string, country string"), ascii_only=True).cache()


def joined(s1, target, k):
    """The same candidates by joins that make a row for each pair and blocker."""
    evidence = [blocking.by_minhash(s1, target), blocking.by_token(s1, target, 20), blocking.by_field(s1, target, "postal_prefix", 1.5), blocking.by_field(s1, target, "street_number", 0.5)]
    return blocking.top_k(blocking.scored_candidates(s1, target, "source2", evidence), k)


@pytest.mark.parametrize("pairs, fewest, grid", [(1 << 20, 512, 1 << 24), (50, 16, 0)])
def test_cells_find_what_joins_find(spark, monkeypatch, pairs, fewest, grid):
    """Equal rows, whether all fits one run or records are dealt to many cells and runs; ids shared by both sides make no pair."""
    monkeypatch.setattr(cells, "FEWEST", fewest)
    monkeypatch.setattr(cells, "RIGHT", 40 if fewest == 16 else cells.RIGHT)
    s1, target = records(spark, 1, 120, 0), records(spark, 2, 150, 100)
    inside = cells.best

    def small(*args):
        cells.PAIRS, cells.GRID = pairs, grid
        return inside(*args)

    monkeypatch.setattr(cells, "best", small)
    for k in (3, 1000):
        got, want = (sorted(tuple(map(str, r)) for r in df.collect()) for df in (blocking.generate(s1, target, "source2", k=k, max_posting=20), joined(s1, target, k)))
        assert got == want and len(want) > 100


def test_no_row_for_each_pair(spark):
    """Candidates come from cells: the plan joins no keys of both sides."""
    s1, target = records(spark, 3, 30, 0), records(spark, 4, 30, 100)
    plan = blocking.generate(s1, target, "source2")._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "source1_id" not in "".join(line for line in plan.splitlines() if "Join" in line)
    none = s1.limit(0)
    assert blocking.generate(none, target, "source2").count() == blocking.generate(s1, none, "source2").count() == 0
    assert blocking.generate(s1.where(F.col("country_normalized") == "peru"), target.where(F.col("country_normalized") == "france"), "source2").count() == 0
