"""Nodes that share several small blocks are a pair once, whatever the number of their blocks."""

from pyspark.sql import functions as F

from linkwright.llm import nearcopies


def test_a_pair_of_many_blocks_is_made_once(spark):
    nodes = spark.range(1, 21).select(F.col("id").alias("th"), F.lit(50).alias("n"), (F.col("id") % 15).alias("root"))
    few = nodes.crossJoin(spark.range(40).select(F.col("id").alias("k"), F.lit(7).alias("v")))
    made = nearcopies._met_few(few, 0.8)
    expected = {(a, b) for a in range(1, 21) for b in range(a + 1, 21) if a % 15 != b % 15}
    rows = [(r["hub"], r["th"]) for r in made.collect()]
    assert len(rows) == len(expected) and set(rows) == expected
    assert {tuple(r) for r in nearcopies._met(few, 0.8).collect()} == expected
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "hub_root" not in plan  # no join makes rows of pairs


def test_sizes_still_count(spark):
    few = spark.createDataFrame([(0, 1, 1, 10, 1), (0, 1, 2, 12, 2), (0, 1, 3, 20, 3)], "k int, v bigint, th bigint, n int, root bigint")
    assert {tuple(r) for r in nearcopies._met_few(few, 0.8).collect()} == {(1, 2)}
