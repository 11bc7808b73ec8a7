from test_cells import records

from linkwright.operators import blocking, cells


def test_records_are_packed_before_they_meet(spark, monkeypatch):
    """A record that meets many cells is sent as part of one row of many records, and comes back as it was."""
    s1 = records(spark, 5, 90, 0).coalesce(1)
    sides = blocking.with_signature(s1).select(*blocking.SLIM, "signature")
    monkeypatch.setattr(cells, "PACKED", 40)
    packed = cells._pack(sides, {"": 2, "france": 1, "peru": 3})
    assert packed.groupBy("country", "part").count().count() == 6 and packed.count() <= 18
    back = cells._unpack(packed.toArrow())
    want = {r["id"]: (r["name_tokens"], r["country_normalized"], r["signature"]) for r in sides.collect()}
    assert {r["id"]: (r["name_tokens"], r["country_normalized"], r["signature"]) for r in back.to_pylist()} == want
    plan = blocking.generate(s1, s1, "source2")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2


def test_cells_wanted_do_not_split_a_country_that_is_little_over():
    assert cells._deal(dict.fromkeys("abcdefghijklmnopqrstuvwxy", 4800), {"": 16000}, 512, 1 << 16) == (dict.fromkeys("abcdefghijklmnopqrstuvwxy", 1), {"": 1})
    assert cells._deal({"a": 3200, "b": 0, "": 1}, {"a": 70000}, 512, 512) == ({"a": 7, "b": 0, "": 1}, {"a": 2})
