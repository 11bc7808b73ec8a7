import duckdb
import pytest

import __spark_entry__ as entry
from linkwright.plans import linkage, oracle

SF = "/root/testdata/sf0.001"


def rows(columns, values):
    order = sorted(columns)
    return sorted(repr([v for _, v in sorted(zip(columns, r))]) for r in values), order


@pytest.mark.parametrize("name", ["name_normalize", "address_parse", "routing_extract", "soundex_codes", "minhash_signature", "blocking_topk", "rule_scores", "keyed_match_strict", "keyed_match_simple", "truth_normalize", "split_holdout"])
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("part", "nation", "customer", "embeddings"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = linkage.QUERIES[name](spark, SF)
    want = con.sql(oracle.SQL[name])
    assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns[:3] == ["source1_id", "target_source", "target_id"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
